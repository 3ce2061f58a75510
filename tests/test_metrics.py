import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import pred_df
from tessera.operators import metrics as M


def brute_metrics(y, p, yp):
    y, p, yp = map(np.asarray, (y, p, yp))
    tp = int(((y == 1) & (yp == 1)).sum()); fp = int(((y == 0) & (yp == 1)).sum())
    fn = int(((y == 1) & (yp == 0)).sum()); tn = int(((y == 0) & (yp == 0)).sum())
    f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
    f0 = 2 * tn / (2 * tn + fp + fn) if 2 * tn + fp + fn else 0.0
    present = [c for c in (0, 1) if (y == c).any() or (yp == c).any()]
    macro = np.mean([f1 if c == 1 else f0 for c in present])
    # AUC by pairwise comparison, AP by definition
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap = 0.0
    for s in np.unique(p)[::-1]:
        sel = p >= s
        prec = (y[sel] == 1).sum() / sel.sum()
        ap += ((y == 1) & (p == s)).sum() / (y == 1).sum() * prec
    return dict(accuracy=(tp + tn) / len(y), f1=f1, macro_f1=macro, roc_auc=auc, pr_auc=ap,
                brier=float(np.mean((p - y) ** 2)))


def test_perfect_scores(spark):
    df = pred_df(spark, [0, 0, 1, 1, 1], [.1, .2, .8, .9, .95]).withColumn(
        "y_pred", (F.col("proba") >= 0.5).cast("int"))
    r = M.binary_metrics(df, ["model", "repeat"]).first()
    assert r.accuracy == 1 and r.f1 == 1 and r.roc_auc == 1 and r.macro_f1 == 1


def test_all_predicted_positive_half_positive(spark):
    df = pred_df(spark, [0, 1] * 5, [0.9] * 10).withColumn("y_pred", F.lit(1))
    r = M.binary_metrics(df, ["model", "repeat"]).first()
    assert r.accuracy == pytest.approx(.5) and r.precision == pytest.approx(.5) and r.recall == 1
    assert r.f1 == pytest.approx(2 / 3) and r.macro_f1 == pytest.approx(1 / 3)
    assert r.balanced_accuracy == pytest.approx(.5)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_random_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 120)
    p = np.round(rng.uniform(0, 1, 120), 2)  # ties on purpose
    yp = (p >= 0.5).astype(int)
    df = pred_df(spark, y, p).withColumn("y_pred", (F.col("proba") >= 0.5).cast("int"))
    got = M.binary_metrics(df, ["model", "repeat"]).first().asDict()
    exp = brute_metrics(y, p, yp)
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-12), k


def test_single_class_auc_null(spark):
    df = pred_df(spark, [1, 1, 1], [.2, .5, .7]).withColumn("y_pred", F.lit(1))
    assert M.binary_metrics(df, ["model", "repeat"]).first().roc_auc is None


def test_threshold_separable(spark):
    df = pred_df(spark, [0, 0, 0, 1, 1, 1], [.1, .2, .3, .7, .8, .9])
    r = M.best_threshold(df, ["model", "repeat"]).first()
    assert r.f1 == 1.0 and 0.3 < r.threshold < 0.7


def test_threshold_no_positives_is_first_grid_point(spark):
    df = pred_df(spark, [0, 0, 0], [.1, .6, .9])
    assert M.best_threshold(df, ["model", "repeat"]).first().threshold == 0.05


@pytest.mark.parametrize("seed", [3, 4])
def test_threshold_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 200)
    p = np.round(rng.uniform(0, 1, 200), 3)
    grid = [round(0.05 + i * 0.01, 12) for i in range(90)] + [0.95]
    best_t, best_f = 0.5, -1.0
    for t in grid:
        yp = p >= t
        tp = int((yp & (y == 1)).sum()); fp = int((yp & (y == 0)).sum()); fn = int((~yp & (y == 1)).sum())
        f = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        if f > best_f:
            best_t, best_f = t, f
    r = M.best_threshold(pred_df(spark, y, p), ["model", "repeat"]).first()
    assert r.threshold == pytest.approx(best_t) and r.f1 == pytest.approx(best_f)


def test_determinism_under_repartition(spark):
    rng = np.random.default_rng(7)
    df = pred_df(spark, rng.integers(0, 2, 300), np.round(rng.uniform(0, 1, 300), 2))
    df = df.withColumn("y_pred", (F.col("proba") >= 0.4).cast("int"))
    a = M.binary_metrics(df.repartition(1), ["model", "repeat"]).first().asDict()
    b = M.binary_metrics(df.repartition(13), ["model", "repeat"]).first().asDict()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_calibration_curve_bins_one_row_a_score(spark):
    rng = np.random.default_rng(11)
    p, y = np.round(rng.beta(0.4, 2, 900), 2), rng.integers(0, 2, 900)
    rows = [("A", int(a), float(b)) for a, b in zip(y, p)] + [("A", None, 0.5), ("A", 1, None), ("B", 1, None), ("C", 0, float("nan")), ("C", 1, -3.5)]
    df = spark.createDataFrame(rows, "model string, y_true int, proba double")
    curve = M.calibration_curve(df, ["model"])
    got = {(r["model"], r["bin"]): (r.prob_pred, r.prob_true, r.n) for r in curve.collect()}
    p, y = np.append(p, 0.5), np.append(y.astype(float), np.nan)
    bins = (np.quantile(p, np.arange(1, 10) / 10)[None] < p[:, None]).sum(1)
    for b in np.unique(bins):
        n_null = int(b == 0)  # the row without a score lies in the first bin
        n = int((bins == b).sum())
        want_y = np.append(y[bins == b], [1.0] * n_null)
        assert got["A", b][2] == n + n_null and got["A", b][0] == pytest.approx(p[bins == b].mean()) and got["A", b][1] == pytest.approx(np.nanmean(want_y))
    assert got["B", None] == (None, 1.0, 1) and got["C", 0][2] == 2  # edges beside a NaN are NaN
    text = curve._jdf.queryExecution().executedPlan().toString()
    # the exchange that deals by the model alone carries one row for each score: it follows a count by score
    assert "percentile" not in text and "BroadcastHashJoin [model" in text
