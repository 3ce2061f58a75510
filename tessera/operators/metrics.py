"""Binary-classification metrics over many evaluation cells at once.

A *cell* is any key (``by`` columns), e.g. ``["model", "repeat"]``.  The
scored-prediction table is scanned exactly once: rows collapse map-side into a
per-(cell, score) histogram, and every metric, the threshold search and the
curves are computed from that histogram.  Cumulative sums over the score
order are done in two levels (coarse score bucket, then inside the bucket),
so one hot cell is spread over many tasks instead of one sorted partition.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import (THRESHOLD_GRID, col, grid_count_le,
                                     grid_value, safe_div)

SCORE_BUCKETS = 1024   # coarse buckets of a probability score for 2-level prefix sums


def _by(by: Sequence[str] | str) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def score_histogram(pred: DataFrame, by, y: str = "y_true", p: str = "proba",
                    y_pred: str | None = "y_pred") -> DataFrame:
    """(cell, score) → pos, neg, and the predicted-positive share of each
    (tp_s, fp_s).  One aggregation of the tall table, partial on the map side."""
    by = _by(by)
    yc = F.col(y).cast("long")
    yp = F.col(y_pred).cast("long") if y_pred else F.lit(0).cast("long")
    return pred.groupBy(*by, F.col(p).cast("double").alias("score")).agg(
        F.sum(yc).alias("pos"),
        F.sum(F.lit(1) - yc).alias("neg"),
        F.sum(yc * yp).alias("tp_s"),
        F.sum((F.lit(1) - yc) * yp).alias("fp_s"))


def label_histogram(pred: DataFrame, by, y: str = "y_true", p: str = "proba") -> DataFrame:
    """(cell, score) → pos, neg: all that thresholds, metrics and matrices need."""
    yc = F.col(y).cast("long")
    return pred.groupBy(*_by(by), F.col(p).cast("double").alias("score")).agg(
        F.sum(yc).alias("pos"), F.sum(F.lit(1) - yc).alias("neg"))


def decided_histogram(hist: DataFrame, thresholds: DataFrame, by, t: str = "threshold") -> DataFrame:
    """Predicted positives (tp_s, fp_s) of each score under its cell's inclusive
    threshold.  One row per cell meets the histogram; scored rows never join."""
    by = _by(by)
    hit = F.col("score") >= F.col(t)
    return hist.join(thresholds.select(*by, t), by).select(
        *by, "score", "pos", "neg", F.when(hit, F.col("pos")).otherwise(F.lit(0).cast("long")).alias("tp_s"),
        F.when(hit, F.col("neg")).otherwise(F.lit(0).cast("long")).alias("fp_s"))


def metrics_at_best_threshold(pred: DataFrame, by=("model", "repeat"), y: str = "y_true", p: str = "proba",
                              grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """The nine metrics at each cell's F1-best threshold: one scan of the scored
    rows and one histogram, which gives both the threshold and the metrics."""
    hist = label_histogram(pred, by, y, p)
    return metrics_of_histogram(decided_histogram(hist, best_threshold_of_histogram(hist, by, grid), by), by)


def confusion_at_best_threshold(pred: DataFrame, by, y: str = "y_true", p: str = "proba",
                                grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """Long 2×2 confusion matrix per cell at its F1-best threshold, from the histogram."""
    by = _by(by)
    hist = label_histogram(pred, by, y, p)
    c = decided_histogram(hist, best_threshold_of_histogram(hist, by, grid), by).groupBy(*by).agg(
        F.sum("tp_s").alias("tp"), F.sum("fp_s").alias("fp"),
        F.sum(F.col("pos") - F.col("tp_s")).alias("fn"), F.sum(F.col("neg") - F.col("fp_s")).alias("tn"))
    return _long_matrix(c, by)


def _long_matrix(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.selectExpr(*by, "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (y_true, y_pred, n)")


def cumulative_desc(hist: DataFrame, by, score: str, values: Sequence[str],
                    buckets: int = SCORE_BUCKETS) -> DataFrame:
    """Inclusive running sums of ``values`` over ``score`` descending, per cell.

    ``hist`` must have one row per (cell, score).  Level 1 sums per coarse
    bucket and prefixes those (≤ buckets+2 rows per cell); level 2 prefixes
    inside each (cell, bucket) partition and adds the bucket offset.
    """
    by = _by(by)
    b = F.least(F.lit(buckets), F.greatest(F.lit(-1), F.floor(F.col(score) * buckets))).cast("int")
    h = hist.withColumn("_bkt", b)
    tot = h.groupBy(*by, "_bkt").agg(*[F.sum(v).alias(v) for v in values])
    w_b = Window.partitionBy(*by).orderBy(F.desc("_bkt")).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*by, "_bkt", *[F.coalesce(F.sum(v).over(w_b), F.lit(0)).alias(f"_off_{v}")
                                     for v in values])
    w_in = Window.partitionBy(*by, "_bkt").orderBy(F.desc(score)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = h.join(offs, [*by, "_bkt"])
    for v in values:
        out = out.withColumn(f"cum_{v}", F.sum(v).over(w_in) + F.col(f"_off_{v}"))
    return out.drop("_bkt", *[f"_off_{v}" for v in values])


def binary_metrics(pred: DataFrame, by=("model", "repeat"), y: str = "y_true",
                   p: str = "proba", y_pred: str = "y_pred") -> DataFrame:
    """The nine metrics per cell: accuracy, precision, recall, f1, macro_f1,
    roc_auc (mid-rank), pr_auc (average precision), balanced_accuracy, brier.

    Zero denominators give 0; roc_auc / pr_auc are NULL for one-class cells;
    macro-F1 averages over classes present in y_true ∪ y_pred; balanced
    accuracy over classes present in y_true.
    """
    return metrics_of_histogram(score_histogram(pred, by, y, p, y_pred), by)


def metrics_of_histogram(hist: DataFrame, by) -> DataFrame:
    """The nine metrics from ``(cell, score) → pos, neg, tp_s, fp_s``."""
    by = _by(by)
    cum = cumulative_desc(hist, by, "score", ["pos", "neg"])
    s = F.col("score")
    agg = cum.groupBy(*by).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum("tp_s").alias("TP"), F.sum("fp_s").alias("FP"),
        F.sum(F.col("pos") * (F.lit(0.5) * F.col("neg") - F.col("cum_neg"))).alias("_auc_part"),
        F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_ap_part"),
        F.sum(F.col("pos") * (F.lit(1.0) - s) * (F.lit(1.0) - s) + F.col("neg") * s * s).alias("_sse"))
    P, N, TP, FP = F.col("P"), F.col("N"), F.col("TP"), F.col("FP")
    FN, TN = P - TP, N - FP
    n = P + N
    prec = safe_div(TP, TP + FP)
    rec = safe_div(TP, P)
    f1_1 = safe_div(2 * TP, 2 * TP + FP + FN)
    f1_0 = safe_div(2 * TN, 2 * TN + FP + FN)
    c1 = ((P + FP) > 0).cast("int")          # class 1 in y_true ∪ y_pred
    c0 = ((N + FN) > 0).cast("int")          # class 0 in y_true ∪ y_pred
    macro = (f1_1 * c1 + f1_0 * c0) / (c1 + c0)
    bal = ((F.when(P > 0, TP / P).otherwise(0.0) + F.when(N > 0, TN / N).otherwise(0.0))
           / ((P > 0).cast("int") + (N > 0).cast("int")))
    one_class = (P == 0) | (N == 0)
    return agg.select(
        *by,
        safe_div(TP + TN, n).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        f1_1.alias("f1"),
        macro.alias("macro_f1"),
        F.when(one_class, F.lit(None).cast("double"))
         .otherwise(F.lit(1.0) + F.col("_auc_part") / (P.cast("double") * N)).alias("roc_auc"),
        F.when(P == 0, F.lit(None).cast("double")).otherwise(F.col("_ap_part") / P).alias("pr_auc"),
        bal.alias("balanced_accuracy"),
        (F.col("_sse") / n).alias("brier"))


def confusion_counts(pred: DataFrame, by, y: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """tp, fp, fn, tn per cell (one pass, partial aggregation)."""
    by = _by(by)
    yc, yp = F.col(y).cast("long"), F.col(y_pred).cast("long")
    return pred.groupBy(*by).agg(
        F.sum(yc * yp).alias("tp"), F.sum((1 - yc) * yp).alias("fp"),
        F.sum(yc * (1 - yp)).alias("fn"), F.sum((1 - yc) * (1 - yp)).alias("tn"))


def confusion_matrix(pred: DataFrame, by, y: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Long 2×2 confusion matrix per cell, zero cells included."""
    by = _by(by)
    return _long_matrix(confusion_counts(pred, by, y, y_pred), by)


def best_threshold(pred: DataFrame, by, y: str = "y_true", p: str = "proba",
                   grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """F1-optimal decision threshold per cell over an evenly spaced grid.

    F1 with zero denominator is 0 and the lowest threshold wins ties, so a cell
    without positives gets the first grid point.  Rows map to the number of
    grid points ≤ p; the (cell, bin) histogram has at most n+1 rows per cell,
    and every threshold between two present bins shares one confusion matrix,
    so only the lowest threshold of each run is a candidate (no grid join).
    """
    yc = F.col(y).cast("long")
    return _best_of_bins(pred.groupBy(*_by(by), grid_count_le(p, *grid).alias("bin")).agg(
        F.sum(yc).alias("pos"), F.sum(1 - yc).alias("neg")), by, grid)


def best_threshold_of_histogram(hist: DataFrame, by, grid: tuple[float, float, int] = THRESHOLD_GRID) -> DataFrame:
    """``best_threshold`` from ``(cell, score) → pos, neg``."""
    return _best_of_bins(hist.groupBy(*_by(by), grid_count_le("score", *grid).alias("bin")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), by, grid)


def _best_of_bins(h: DataFrame, by, grid: tuple[float, float, int]) -> DataFrame:
    by = _by(by)
    lo, hi, n = grid
    cell = Window.partitionBy(*by)
    down = cell.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.select(*by, "bin",
                 F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
                 F.sum("pos").over(cell).alias("P"), F.max("bin").over(cell).alias("top"),
                 F.coalesce(F.lag("bin").over(cell.orderBy("bin")), F.lit(0)).alias("i"))
    run_start = h.filter(F.col("bin") >= 1).select(*by, "i", "tp", "fp", "P")
    above_all = (h.filter((F.col("bin") == F.col("top")) & (F.col("top") < n))
                 .select(*by, F.col("top").alias("i"), F.lit(0).cast("long").alias("tp"),
                         F.lit(0).cast("long").alias("fp"), "P"))
    cand = run_start.unionByName(above_all)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")
    cand = cand.withColumn("f1", safe_div(2 * tp, 2 * tp + fp + fn))
    rank = Window.partitionBy(*by).orderBy(F.desc("f1"), F.asc("i"))
    return (cand.withColumn("_r", F.row_number().over(rank)).filter("_r = 1")
            .select(*by, grid_value(F.col("i"), lo, hi, n).alias("threshold"), "f1"))


def apply_threshold(pred: DataFrame, thresholds: DataFrame, by, p: str = "proba",
                    t: str = "threshold", out: str = "y_pred") -> DataFrame:
    """Attach each cell's threshold and the inclusive decision ``p >= t``.

    For rows that need the decision itself; metrics and matrices take it from
    the histogram (``metrics_at_best_threshold``) without a join of the rows.
    """
    by = _by(by)
    return (pred.join(thresholds.select(*by, t), by)
            .withColumn(out, (F.col(p) >= F.col(t)).cast("int")))


def _histogram_quantiles(hist: DataFrame, by, shares: Sequence[float], p: str, n: str) -> DataFrame:
    """Interpolated quantiles of each cell, as ``percentile``, from one row for each
    distinct ``p`` and how often it comes (``n``): ``by…, _edges`` (null without values).

    The places of the values in their order come from running sums in two
    levels, as in ``cumulative_desc``, so no cell is sorted in one task."""
    k, times = F.col(p), F.when(F.col(p).isNotNull(), F.col(n)).otherwise(0)
    bucket = F.when(F.isnan(k), SCORE_BUCKETS).otherwise(F.least(F.lit(SCORE_BUCKETS), F.greatest(F.lit(-1), F.floor(k * SCORE_BUCKETS))))
    h = hist.select(*by, k.alias("_v"), times.alias("_c"), bucket.cast("int").alias("_bkt"))
    before = Window.partitionBy(*by).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = h.groupBy(*by, "_bkt").agg(F.sum("_c").alias("_s")).select(
        *by, "_bkt", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"), F.sum("_s").over(Window.partitionBy(*by)).alias("_t"))
    inner = Window.partitionBy(*by, "_bkt").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = h.join(offs, [*by, "_bkt"]).withColumn("_to", F.col("_off") + F.sum("_c").over(inner))
    at = [(F.col("_t") - 1) * F.lit(q) for q in shares]
    there = lambda r: F.max(F.when((F.col("_to") - F.col("_c") <= r) & (r < F.col("_to")), F.col("_v")))
    got = c.groupBy(*by, "_t").agg(*[there(f(a)).alias(f"_{w}{i}") for i, a in enumerate(at) for w, f in (("lo", F.floor), ("hi", F.ceil))])
    edges = [F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(
        (F.ceil(a) - a) * F.col(f"_lo{i}") + (a - F.floor(a)) * F.col(f"_hi{i}")) for i, a in enumerate(at)]
    return got.select(*by, F.when(F.col("_t") > 0, F.array(*edges)).alias("_edges"))


def calibration_curve(pred: DataFrame, by=("model",), y: str = "y_true", p: str = "proba",
                      n_bins: int = 10, approx: bool = False) -> DataFrame:
    """Reliability curve with quantile bins pooled over everything not in ``by``.

    Edges are the interpolated quantiles k/n_bins; a row's bin is the number
    of interior edges strictly below p; empty bins are omitted.  ``approx``
    swaps the exact quantiles for the mergeable ``percentile_approx``.

    Rows collapse map-side into one for each distinct score, and only those
    meet their cell's edges.
    """
    by = _by(by)
    qs = [k / n_bins for k in range(1, n_bins)]
    yd = F.col(y).cast("double")
    hist = pred.groupBy(*by, F.col(p).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(yd).alias("_ny"), F.sum(yd).alias("_y"))
    if approx:
        q = F.array(*[F.lit(x) for x in qs])
        edges = pred.groupBy(*by).agg(F.percentile_approx(F.col(p), q, 100000).alias("_edges"))
    else:
        edges = _histogram_quantiles(hist, by, qs, "_p", "_n")
    binned = hist.join(F.broadcast(edges), by).withColumn(  # one row for each cell
        "bin", F.size(F.filter("_edges", lambda e: e < F.col("_p"))))
    present = F.when(F.col("_p").isNotNull(), F.col("_n"))
    return binned.groupBy(*by, "bin").agg(
        (F.sum(F.col("_p") * F.col("_n")) / F.sum(present)).alias("prob_pred"),
        F.when(F.sum("_ny") > 0, F.sum("_y") / F.sum("_ny")).alias("prob_true"), F.sum("_n").alias("n"))


def curve_points(pred: DataFrame, by, kind: str, y: str = "y_true", p: str = "proba") -> DataFrame:
    """Raw ROC (fpr, tpr) or PR (recall, precision) points per cell, one per
    distinct score plus the origin point of the library curve."""
    by = _by(by)
    hist = pred.groupBy(*by, F.col(p).cast("double").alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum(1 - F.col(y).cast("long")).alias("neg"))
    cum = cumulative_desc(hist, by, "score", ["pos", "neg"])
    tot = Window.partitionBy(*by)
    cum = cum.withColumn("P", F.sum("pos").over(tot)).withColumn("N", F.sum("neg").over(tot))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    if kind == "roc":
        pts = cum.select(*by, safe_div(fp, F.col("N"), None).alias("x"),
                         safe_div(tp, F.col("P"), None).alias("y"))
        origin = cum.select(*by).distinct().select(*by, F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    elif kind == "pr":
        pts = cum.select(*by, F.when(F.col("P") == 0, F.lit(1.0)).otherwise(tp / F.col("P")).alias("x"),
                         safe_div(tp, tp + fp).alias("y"))
        origin = cum.select(*by).distinct().select(*by, F.lit(0.0).alias("x"), F.lit(1.0).alias("y"))
    else:
        raise ValueError(f"unknown curve kind: {kind}")
    return pts.unionByName(origin)


def _grid_interval(x: F.Column, n: int) -> F.Column:
    """Index k of the grid interval [k/(n-1), (k+1)/(n-1)) holding x (exact)."""
    m = n - 1
    k0 = F.least(F.lit(m), F.greatest(F.lit(0), F.floor(x * m))).cast("int")
    up = F.when((k0 < m) & ((k0 + 1) / F.lit(float(m)) <= x), k0 + 1).otherwise(k0)
    return F.when((up > 0) & (up / F.lit(float(m)) > x), up - 1).otherwise(up)


def interpolate_on_grid(points: DataFrame, by, n: int = 200) -> DataFrame:
    """Linear interpolation of per-cell curves ``(cell…, x, y)`` at x_k = k/(n-1).

    Matches the library interpolation of a curve whose duplicated x values are
    ordered by y: at an x hit exactly (or from the left) the largest y counts,
    approaching from the right the smallest; outside the range the end values
    hold.  Points are first reduced per (cell, grid interval) to at most three
    (exact hit, first beyond the grid point, last), so the window over each
    cell has n rows whatever the number of distinct scores."""
    by = _by(by)
    m = float(n - 1)
    pts = points.groupBy(*by, "x").agg(F.min("y").alias("ylo"), F.max("y").alias("yhi"))
    pts = pts.withColumn("k", _grid_interval(F.col("x"), n))
    xk_of_k = F.col("k") / F.lit(m)
    on_grid = F.col("x") == xk_of_k
    per = pts.groupBy(*by, "k").agg(
        F.max(F.when(on_grid, F.col("yhi"))).alias("exact_y"),
        F.min(F.when(~on_grid, F.col("x"))).alias("gt_x"),
        F.min_by(F.when(~on_grid, F.col("ylo")), F.when(~on_grid, F.col("x"))).alias("gt_y"),
        F.max("x").alias("last_x"), F.max_by("yhi", "x").alias("last_y"),
        F.min("x").alias("first_x"), F.min_by("ylo", "x").alias("first_y"))
    grid = (points.select(*by).distinct()
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))))
    g = grid.join(per, [*by, "k"], "left")
    w = Window.partitionBy(*by).orderBy("k")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    xk = F.col("k") / F.lit(m)
    g = g.select(*by, "k", xk.alias("xk"), "exact_y", "gt_x", "gt_y",
                 F.last("last_x", ignorenulls=True).over(before).alias("pl_x"),
                 F.last("last_y", ignorenulls=True).over(before).alias("pl_y"),
                 F.first("first_x", ignorenulls=True).over(after).alias("nf_x"),
                 F.first("first_y", ignorenulls=True).over(after).alias("nf_y"))
    xl = F.when(F.col("exact_y").isNotNull(), F.col("xk")).otherwise(F.col("pl_x"))
    yl = F.coalesce(F.col("exact_y"), F.col("pl_y"))
    xr = F.coalesce(F.col("gt_x"), F.col("nf_x"))
    yr = F.when(F.col("gt_x").isNotNull(), F.col("gt_y")).otherwise(F.col("nf_y"))
    y = (F.when(xl.isNull(), yr)
          .when(xr.isNull() | (F.col("xk") == xl), yl)
          .otherwise(yl + (F.col("xk") - xl) * (yr - yl) / (xr - xl)))
    return g.select(*by, "k", "xk", y.alias("y"))


def mean_curve(pred: DataFrame, kind: str, by=("model",), over=("repeat",), y: str = "y_true",
               p: str = "proba", n: int = 200) -> DataFrame:
    """Per-cell ROC (tpr at fpr grid) or PR (precision at recall grid),
    interpolated on an n-point grid and averaged over the ``over`` cells.  ROC
    pins the first point to 0 before and the last mean to 1 after averaging."""
    by, over = _by(by), _by(over)
    cell = by + over
    pts = curve_points(pred, cell, kind, y, p)
    if kind == "pr":   # one point per recall: the highest precision
        pts = pts.groupBy(*cell, "x").agg(F.max("y").alias("y"))
    curve = interpolate_on_grid(pts, cell, n)
    if kind == "roc":
        curve = curve.withColumn("y", F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.col("y")))
    out = curve.groupBy(*by, "k").agg(F.first("xk").alias("x"), F.avg("y").alias("y"))
    if kind == "roc":
        out = out.withColumn("y", F.when(F.col("k") == n - 1, F.lit(1.0)).otherwise(F.col("y")))
    return out
