import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import prep as P
from tessera.operators import select as SEL


def samples_df(spark, X, y=None, groups=None):
    n = X.shape[0]
    y = np.zeros(n, dtype=int) if y is None else y
    groups = [f"g{i % 10}" for i in range(n)] if groups is None else groups
    rows = [(int(i), str(groups[i]), int(y[i]), [None if np.isnan(v) else float(v) for v in X[i]])
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, patient_id string, label int, features array<double>")


def fit_all(spark, X, y=None):
    df = samples_df(spark, X, y)
    cells = df.select(F.lit(0).alias("repeat"), "patient_id").distinct()
    return df, P.FeaturePrep(["repeat"]).fit(df, cells)


def kept(model):
    return sorted(r.feature_idx for r in model.params.filter("keep").collect())


def test_near_duplicate_keeps_two_of_three(spark):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=100)
    X = np.c_[x1, x1 + rng.normal(0, 0.01, 100), rng.normal(size=100)]
    _, m = fit_all(spark, X)
    assert kept(m) == [1, 3]


def test_independent_kept(spark):
    X = np.random.default_rng(1).normal(size=(80, 5))
    _, m = fit_all(spark, X)
    assert kept(m) == [1, 2, 3, 4, 5]


def test_constant_column_is_safe_and_output_finite(spark):
    rng = np.random.default_rng(2)
    X = np.c_[rng.normal(size=50), np.ones(50), rng.normal(size=50)]
    df, m = fit_all(spark, X)
    assert kept(m) == [1, 3]           # constant removed by the variance filter
    rows = df.withColumn("repeat", F.lit(0))
    out = m.transform(rows).select("x").collect()
    assert all(np.isfinite(v) for r in out for v in r.x)


def test_ordered_filter_is_not_transitive(spark):
    # chain 1-2 and 2-3 correlated, 1-3 not: greedy keeps 1 and 3
    nodes = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "repeat int, feature_idx int")
    edges = spark.createDataFrame([(0, 1, 2, .99), (0, 2, 3, .99)], "repeat int, i int, j int, r double")
    got = sorted(r.feature_idx for r in P.ordered_independent_set(nodes, edges, ["repeat"]).collect())
    assert got == [1, 3]


def test_median_and_robust_scale_exact(spark):
    X = np.array([[1.0], [2.0], [4.0], [8.0], [np.nan]])
    _, m = fit_all(spark, X)
    p = m.params.first()
    assert p.median == 3.0                       # exact interpolated median, NaN ignored
    # imputed values {1,2,3,4,8}: q1 = 2, q3 = 4
    assert (p.q1, p.q3, p.scale) == (2.0, 4.0, 2.0)


def brute_mi(x, y, k=3):
    from math import fsum

    def psi(n):
        return fsum(1.0 / t for t in range(1, n)) - 0.5772156649015329
    n = len(x)
    keep = [i for i in range(n) if (y == y[i]).sum() > 1]
    rs, ks, ls = {}, {}, {}
    for i in keep:
        same = [abs(x[j] - x[i]) for j in keep if y[j] == y[i] and j != i]
        kk = min(k, len(same))
        rs[i] = sorted(same)[kk - 1]
        ks[i] = kk
        ls[i] = len(same) + 1
    ms = {}
    for i in keep:
        r = rs[i]
        if r > 0:
            # interval form with bounds snapped to a same-label point at distance exactly r
            up = [x[j] for j in keep if y[j] == y[i] and x[j] > x[i] and x[j] - x[i] == r]
            dn = [x[j] for j in keep if y[j] == y[i] and x[j] < x[i] and x[i] - x[j] == r]
            hi = min(up) if up else x[i] + r
            lo = max(dn) if dn else x[i] - r
            ms[i] = sum(1 for j in keep if lo < x[j] < hi)
        else:
            ms[i] = sum(1 for j in keep if x[j] == x[i])
    N = len(keep)
    mi = psi(N) + np.mean([psi(ks[i]) for i in keep]) - np.mean([psi(ls[i]) for i in keep]) \
        - np.mean([psi(ms[i]) for i in keep])
    return max(0.0, mi)


@pytest.mark.parametrize("seed", [0, 1])
def test_mi_knn_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 120)
    x = np.round(y * 0.8 + rng.normal(size=120), 1)      # coarse values: ties on purpose
    rows = [(0, 1, int(i), int(y[i]), float(x[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "repeat int, feature_idx int, row_id long, label int, x double")
    got = SEL.mutual_info_knn(df, ["repeat"]).first().mi
    assert got == pytest.approx(brute_mi(x, y), abs=1e-10)


def test_mrmr_finds_informative_and_caps_k(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 200)
    inf = np.c_[[y + rng.normal(0, .5, 200) for _ in range(5)]].T
    X = np.c_[inf, rng.normal(size=(200, 15))]
    rows = [(0, j + 1, int(i), int(y[i]), float(X[i, j])) for i in range(200) for j in range(20)]
    long = spark.createDataFrame(rows, "repeat int, feature_idx int, row_id long, label int, x double")
    rel = SEL.mutual_info_knn(long, ["repeat"])
    C = np.corrcoef(X, rowvar=False)
    corr = spark.createDataFrame([(0, i + 1, j + 1, float(C[i, j])) for i in range(20) for j in range(i + 1, 20)],
                                 "repeat int, i int, j int, r double")
    sel = [r.feature_idx for r in SEL.mrmr(rel, corr, ["repeat"], 5).orderBy("step").collect()]
    assert len(sel) == 5 and len(set(sel) & {1, 2, 3, 4, 5}) >= 3
    small = SEL.mrmr(rel.filter("feature_idx <= 4"), corr.filter("i <= 4 AND j <= 4"), ["repeat"], 10)
    assert small.count() == 4


def test_mrmr_prefix_property(spark):
    rng = np.random.default_rng(4)
    d = 12
    rel = spark.createDataFrame([(0, j + 1, float(v)) for j, v in enumerate(rng.uniform(0, 1, d))],
                                "repeat int, feature_idx int, mi double")
    corr = spark.createDataFrame([(0, i + 1, j + 1, float(rng.uniform(-1, 1))) for i in range(d)
                                  for j in range(i + 1, d)], "repeat int, i int, j int, r double")
    a = [r.feature_idx for r in SEL.mrmr(rel, corr, ["repeat"], 4).orderBy("step").collect()]
    b = [r.feature_idx for r in SEL.mrmr(rel, corr, ["repeat"], 9).orderBy("step").collect()]
    assert b[:4] == a


def test_registered_selection_is_the_largest_k_and_stability_its_first_twenty(spark, monkeypatch):
    import inspect

    from pyspark.sql import functions as F

    from tessera.plans import queries as Q

    assert inspect.signature(Q.mrmr_selection).parameters["k"].default == 100
    rows = [(r, s, s + 1 + (s >= 20) * r, 0.0) for r in range(2) for s in range(30)]
    made = spark.createDataFrame(rows, "repeat int, step int, feature_idx int, score double")
    monkeypatch.setattr(Q, "mrmr_selection", lambda *a: made)
    got = Q.q_selection_stability(spark, "").agg(F.min("feature_idx"), F.max("feature_idx"), F.count("*")).first()
    assert tuple(got) == (1, 20, 20)
    assert Q.q_mrmr_topk(spark, "").count() == 60


def test_values_travel_packed_and_once(spark, monkeypatch):
    """One exchange of binary runs for each statistic, whatever the number of rows and batches."""
    from tessera.operators import packed

    monkeypatch.setattr(packed, "PACKED_ROWS", 7)
    rng = np.random.default_rng(6)
    x, y = np.round(rng.normal(size=300), 1), rng.integers(0, 3, 300)
    rows = [(c, f, int(i), None if y[i] == 2 else int(y[i]), float(x[i]) * f) for c in ("a", None) for f in (1, 2) for i in range(300)]
    long = spark.createDataFrame(rows, "cell string, feature_idx int, row_id long, label int, x double").repartition(5)
    mi, value = SEL.mutual_info_knn(long, ["cell"]), F.when(F.col("row_id") > 50, F.col("x"))
    med = P.medians(long.withColumn("value", value), ["cell"])
    st = P.imputed_stats(long.withColumn("value", value), med, ["cell"])
    for df in (mi, med):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning(cell") == 1 and "Window" not in text and "ObjectHashAggregate" not in text
    assert mi.count() == 4 and mi.select("mi").distinct().count() == 1  # both cells alike, whole multiples keep the order
    present = x[51:]
    want = np.concatenate([present, np.full(51, np.median(present))])
    for r in st.collect():
        f = r.feature_idx
        assert r.n == 300 and r.median == pytest.approx(f * np.median(present)) and r.var_pop == pytest.approx(f * f * want.var())
        assert (r.q1, r.q3) == pytest.approx(tuple(f * np.quantile(want, [0.25, 0.75])))
    assert {r.n_present for r in med.collect()} == {249}


def test_mi_knn_of_two_labels_matches_brute_force_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(7)
    y, x = (rng.random(90) < 0.03).astype(int), np.round(rng.normal(size=90), 1)
    y[:2] = 1                                            # few positives: fewer than three neighbours
    monkeypatch.setattr(SEL, "POINTS", 11)
    assert SEL._knn_information(x, y.astype(np.int32), 3)["mi"] == pytest.approx(brute_mi(x, y), abs=1e-10)
