import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 70 and len({(r["model"], r["repeat"]) for r in rows}) == 70  # 7 models x 10 suppliers at this size
    assert all(0 < r["macro_f1"] <= 1 for r in rows)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
