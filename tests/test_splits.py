from pyspark.sql import functions as F

from tessera.operators import data as D
from tessera.operators import splits as SP


def groups_df(spark, n_groups=69, rows=14):
    data = [(f"G_{g}", g % 2) for g in range(n_groups) for _ in range(rows)]
    return spark.createDataFrame(data, "patient_id string, label int")


def test_split_sizes_69_groups(spark):
    a = SP.group_split(groups_df(spark), n_repeats=3)
    c = {(r.repeat, r.split): r["count"] for r in a.groupBy("repeat", "split").count().collect()}
    for rep in range(3):
        assert c[(rep, "test")] == 14 and c[(rep, "val")] == 7 and c[(rep, "train")] == 48


def test_no_leakage_and_every_group_once(spark):
    df = groups_df(spark)
    a = SP.group_split(df, n_repeats=4)
    assert SP.leakage_violations(SP.assign_rows(df, a)).count() == 0
    assert a.groupBy("repeat", "patient_id").count().filter("count > 1").count() == 0


def test_split_deterministic_under_repartition(spark):
    df = groups_df(spark)
    a = SP.group_split(df.repartition(1), n_repeats=2).orderBy("repeat", "patient_id").collect()
    b = SP.group_split(df.repartition(11), n_repeats=2).orderBy("repeat", "patient_id").collect()
    assert a == b


def test_stratified_folds_balanced(spark):
    df = groups_df(spark, 40, 3)
    f = SP.stratified_group_kfold(df, k=5, n_repeats=2)
    strata = SP.majority_label(df).select("patient_id", "stratum")
    c = f.join(strata, "patient_id").groupBy("repeat", "stratum", "fold").count().collect()
    by = {}
    for r in c:
        by.setdefault((r.repeat, r.stratum), []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_prefix_ids_and_mixed_label_report(spark):
    a = spark.createDataFrame([(1, "Right"), (2, "Left"), (1, "Left")], "PatientIndex int, SideStandard string")
    b = spark.createDataFrame([(1, "Right"), (2, "Left"), (3, "Left")], "PatientIndex int, SideStandard string")
    u = D.union_sources({"N": (a, 0), "P": (b, 1)})
    ids = sorted(r.patient_id for r in u.collect())
    assert ids == ["N_1", "N_1", "N_2", "P_1", "P_2", "P_3"]
    assert D.label_overlap(u).count() == 0
    mixed = spark.createDataFrame([("u1", 0), ("u1", 1), ("u2", 0)], "patient_id string, label int")
    assert [r.patient_id for r in D.mixed_label_groups(mixed).collect()] == ["u1"]


def test_leakage_check_hashes_every_row_and_keeps_sets_of_repeats(spark, tmp_path):
    import hashlib

    from tessera.plans import queries as Q

    rows = [(o, i, 7 * o + i if o % 5 else None, None if o == 3 else o % 11) for o in range(1, 40) for i in range(1, 3)] + [(None, None, None, 30), (None, None, None, 30)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").withColumn("l_quantity", F.lit(1.0))
    df.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = {}
    for o, i, p, s in rows:
        for r in range(20):
            text = ":".join(["42", str(r)] + [str(v) for v in (o, i, p) if v is not None])
            seen.setdefault((r, s), set()).add(hashlib.md5(text.encode()).hexdigest()[0] in "012")
    out = Q.q_leakage_check(spark, str(tmp_path))
    assert {r.kind: r.n_violations for r in out.collect()} == {"group": 0, "row": sum(len(v) == 2 for v in seen.values())}
    assert "bit_or" in out._jdf.queryExecution().executedPlan().toString()
