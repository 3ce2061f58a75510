import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import calibrate as C
from tessera.operators import models as MD
from tessera.streaming.scoring import score_stream


def test_platt_matches_newton_reference(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    s = y * 1.0 + rng.normal(0, 1, 300)
    df = spark.createDataFrame([("M", 0, int(a), float(b)) for a, b in zip(y, s)],
                               "model string, repeat int, y_true int, score double")
    got = C.platt_fit(df, ["model", "repeat"]).first()
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, np.log((n0 + 1) / (n1 + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(a * s + b)); r = t - p; h = p * (1 - p)
        g = np.array([(r * s).sum(), r.sum()])
        H = np.array([[(h * s * s).sum(), (h * s).sum()], [(h * s).sum(), h.sum()]])
        d = np.linalg.solve(H, g); a, b = a - d[0], b - d[1]
    assert got.a == pytest.approx(a, abs=1e-9) and got.b == pytest.approx(b, abs=1e-9) and got.converged
    early = C.platt_fit(df, ["model", "repeat"], max_iter=1).first()
    assert not early.converged


def test_platt_apply_pairs_sum_to_one_and_stream_scoring(spark):
    df = spark.createDataFrame([("M", 0, 1, 2.0), ("M", 0, 0, -1.0)], "model string, repeat int, y_true int, score double")
    params = spark.createDataFrame([("M", 0, -1.5, 0.2)], "model string, repeat int, a double, b double")
    out = C.platt_apply(df, params, ["model", "repeat"], s="score").collect()
    for r in out:
        assert 0 <= r.proba <= 1 and r.proba_pair[0] + r.proba_pair[1] == pytest.approx(1.0)
    thr = spark.createDataFrame([("M", 0, 0.5)], "model string, repeat int, threshold double")
    scored = score_stream(df, params, thr, ["model", "repeat"]).orderBy("score").collect()
    assert [r.y_pred for r in scored] == [0, 1]


def test_soft_vote_mean_and_completeness(spark):
    rows = [("RF", 0, 1, 0.2), ("GB", 0, 1, 0.4), ("ET", 0, 1, 0.9), ("RF", 0, 2, 0.5)]
    df = spark.createDataFrame(rows, "model string, repeat int, row_id int, proba double")
    out = C.soft_vote(df.filter("row_id = 1"), ["RF", "ET", "GB"], ["repeat", "row_id"]).collect()
    assert len(out) == 1 and out[0].proba == pytest.approx(0.5)
    with pytest.raises(Exception, match="lacks a member"):
        C.soft_vote(df, ["RF", "ET", "GB"], ["repeat", "row_id"]).collect()
    twice = df.filter("row_id = 1 and model <> 'ET'").union(df.filter("model = 'GB'"))
    with pytest.raises(Exception, match="repeats one"):
        C.soft_vote(twice, ["RF", "ET", "GB"], ["repeat", "row_id"]).collect()


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0, 1)] * 3 + [(0, 0)] * 1, "repeat int, label int")
    w = {r.label: r.weight for r in MD.class_weights(df, ["repeat"]).distinct().collect()}
    assert w[1] == pytest.approx(4 / 6) and w[0] == pytest.approx(4 / 2)


def test_trial_table_ranges_and_determinism(spark):
    t = MD.trial_table(spark, ["LR", "RF", "GB"], 20)
    p = MD.trial_params(t)
    assert p == MD.trial_params(MD.trial_table(spark, ["LR", "RF", "GB"], 20))
    for (m, _), d in p.items():
        assert d["mrmr_k"] in (20, 50, 100)
        if m == "LR":
            assert 1e-3 <= d["C"] <= 1e2 and d["penalty"] in ("l1", "l2")
        if m == "RF":
            assert 100 <= d["n_estimators"] <= 500 and d["n_estimators"] % 50 == 0
            assert 3 <= d["max_depth"] <= 20 and d["max_features"] in ("sqrt", "log2")
        if m == "GB":
            assert 0.5 <= d["subsample"] <= 1.0 and 1e-3 <= d["learning_rate"] <= 0.3


def test_registry_rejects_unknown_model():
    with pytest.raises(ValueError):
        MD.build_estimator("XYZ", {}, 1.0)


def test_knn_votes_and_ties(spark):
    train = spark.createDataFrame([(1, 1, [0.0, 0.0]), (2, 0, [0.0, 2.0]), (3, 0, [3.0, 0.0]), (4, 1, [9.0, 9.0])],
                                  "row_id int, label int, xs array<double>")
    q = spark.createDataFrame([(10, [0.0, 1.0]), (11, [0.0, 0.0])], "row_id int, xs array<double>")
    get = lambda **kw: {r.row_id: r.score for r in MD.knn_scores(train, q, **kw).collect()}
    assert get(k=2) == {10: 0.5, 11: 0.5}
    assert get(k=1) == {10: 1.0, 11: 1.0}  # rows 1 and 2 are equally near to row 10: the smaller key wins
    assert get(k=2, weights="distance")[11] == 1.0
    assert get(k=3, weights="distance", metric="manhattan")[10] == pytest.approx(1 / (1 + 1 + 0.25))
    assert MD.knn_scores(train, train, 1, exclude_self=True).filter("row_id = 1").first().score == 0.0
    with pytest.raises(ValueError):
        MD.knn_scores(train, q, 1, metric="cosine")


def test_exact_knn_uses_every_row_whatever_the_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, [float(v) for v in rng.integers(0, 6, 2)]) for i in range(60)]  # equal distances on purpose
    df = spark.createDataFrame([*rows, rows[3]], "row_id int, label int, xs array<double>")
    for weights, metric in (("uniform", "euclidean"), ("distance", "manhattan")):
        get = lambda f, **kw: sorted((r.row_id, round(r.score, 9)) for r in f(df.limit(60), df, 5, weights, metric, exclude_self=True, **kw).collect())
        whole = get(MD.knn_scores)
        assert len(whole) == 61 and get(MD.knn_scores_exact, block_rows=7) == whole == get(MD.knn_scores_exact)
        assert get(MD.knn_scores, max_train_rows=20) != whole


def test_registered_knn_uses_every_row(spark, monkeypatch):
    from tessera.plans import queries as Q
    from tests.conftest import SF001

    want = Q.REGISTRY["knn_score"](spark, SF001).orderBy("row_id").collect()
    monkeypatch.setattr(MD.knn_scores, "__defaults__", tuple(10 if d == MD.KNN_TRAIN_ROWS else d for d in MD.knn_scores.__defaults__))
    assert Q.REGISTRY["knn_score"](spark, SF001).orderBy("row_id").collect() == want


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_nearest_rows_are_exact_from_few_candidates(metric):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x[:300] = x[7]                                   # a large group of copies
    for points in (x, x * 1e-25 + 1.0, np.round(x), x * 1e200, x * 1e25):
        q, keys = points[:40], np.arange(3000)
        apart = q[:, None] - points[None]
        with np.errstate(over="ignore"):
            d = np.sqrt((apart ** 2).sum(-1)) if metric == "euclidean" else np.abs(apart).sum(-1)
        d[np.arange(40), np.arange(40)] = np.inf
        want = np.argsort(d, axis=1, kind="stable")[:, :5]
        with np.errstate(over="ignore"):
            got = list(MD._nearest(q, keys[:40], points, keys, 5, metric, True))
        for i, (dist, places) in enumerate(got):
            n = int(np.isfinite(d[i, want[i]]).sum())
            assert places.tolist() == want[i, :n].tolist() and dist.tolist() == d[i, want[i, :n]].tolist()
    other = np.ones((100, 3000), bool)
    assert MD._may_be_near(x[300:400], x, other, 5, metric).sum() < 100 * 20  # not all pairs are gone through exactly


def test_registered_knn_searches_once_for_each_metric(spark, monkeypatch):
    from tessera.plans import queries as Q
    from tests.conftest import SF001

    asked, search = [], MD.nearest_rows
    monkeypatch.setattr(MD, "nearest_rows", lambda *a, **kw: asked.append(a[3]) or search(*a, **kw))
    Q.REGISTRY["knn_score"](spark, SF001)
    assert asked == ["euclidean", "manhattan"]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_exact_knn_writes_each_row_once_whatever_the_blocks(spark, metric):
    """The tasks read the training rows from one set of files; no row or list is copied for each block."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(230, 3)), 1)  # ties
    df = spark.createDataFrame([(int(k), int(k % 2), v.tolist()) for k, v in zip(rng.permutation(230), x)], "row_id int, label int, xs array<double>")
    files = MD.training_files(df)
    keys = [k for f in files for k in pq.read_table(f.removeprefix("file:")).column("k").to_pylist()]
    assert keys == list(range(230))
    found = MD.nearest_rows(df, MD.spread(df, 50), 4, metric, block_rows=7, exclude_self=True, files=files)
    assert "CoGroup" not in found._jdf.queryExecution().toString() and "Generate" not in found._jdf.queryExecution().toString()
    rows = df.orderBy("row_id").collect()
    points = np.array([r.xs for r in rows])
    for r in found.collect():
        d = np.sqrt(((points - r.xs) ** 2).sum(1)) if metric == "euclidean" else np.abs(points - r.xs).sum(1)
        d[r.row_id] = np.inf
        want = np.argsort(d, kind="stable")[:4]
        assert [(e.ks, e.d, e.ys) for e in r.n] == [(int(k), d[k], float(k % 2)) for k in want]


def test_exact_knn_of_odd_rows(spark):
    shape = "row_id int, label int, xs array<double>"
    df = spark.createDataFrame([(1, 1, [0.0]), (1, 1, [0.0]), (2, None, [1.0]), (3, 0, [9.0]), (None, 0, [9.5])], shape)
    got = {(r.row_id, r.xs[0]): r.score for r in MD.knn_scores_exact(df, df, 1, exclude_self=True).collect()}
    assert np.isnan(got[(1, 0.0)]) and got[(2, 1.0)] == 1.0 and got[(3, 9.0)] == 0.0 and len(got) == 4
    assert MD.knn_scores_exact(df, df, 1).count() == 5
    none = spark.createDataFrame([], shape)
    assert all(np.isnan(r.score) for r in MD.knn_scores_exact(none, df, 1).collect()) and MD.knn_scores_exact(df, none, 1).count() == 0


def test_knn_of_cells_without_labels(spark):
    """A vote of a row without label is no score, and a query without label has no truth."""
    from tessera.operators import cells as C

    rows = spark.createDataFrame([(0, "fit", 1, 1, [0.0]), (0, "fit", 2, None, [5.0]), (0, "held", 3, 0, [0.1]), (0, "held", 4, 1, [4.9]), (0, "held", 5, None, [0.2])],
                                 "cell int, role string, row_id long, label int, xs array<double>").withColumn("weight", F.lit(1.0))
    fit, held = (C.block_table(rows.filter(F.col("role") == r), c).checkpoint() for r, c in (("fit", ["cell"]), ("held", ["cell", "role"])))
    fits = spark.createDataFrame([(0, 0, "KNN", '{"n_neighbors": 1, "weights": "distance", "metric": "euclidean", "mrmr_k": 20}')], "fit int, cell int, program string, params string")
    got = {r.row_id: (r.y_true, r.score) for r in MD.knn_cells(fit, held, fits, ["cell"]).collect()}
    assert got == {3: (0, 1.0), 4: (1, None), 5: (None, 1.0)}
