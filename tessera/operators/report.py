"""Post-run analytics over the long metric table ``(model, repeat, metrics…)``:
summaries, pivots, rankings, running curves, box statistics, stability
quadrant.  The inputs are one row per (model, repeat) — tiny next to the
prediction table — so global windows over models are cheap here."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import fmt_mean_std
from tessera.sources.tables import METRIC_COLUMNS

LOWER_IS_BETTER = ("brier",)


def unpivot_metrics(metrics: DataFrame, keys: Sequence[str] = ("model", "repeat"),
                    names: Sequence[str] = METRIC_COLUMNS) -> DataFrame:
    """Wide metric columns → ``(keys…, metric, value)``."""
    names = [n for n in names if n in metrics.columns]
    return metrics.unpivot(list(keys), list(names), "metric", "value")


def metric_summary(metrics: DataFrame, names: Sequence[str] = METRIC_COLUMNS) -> DataFrame:
    """A6 + A8 + P16: per (model, metric) mean, sample std (ddof 1), repeats and
    the display string ``m ± s``."""
    long = unpivot_metrics(metrics, names=names)
    s = long.groupBy("model", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.countDistinct("repeat").alias("n_repeats"))
    return s.withColumn("display", fmt_mean_std("mean", "std"))


def metric_pivot(metrics: DataFrame, metric: str, models: Sequence[str]) -> DataFrame:
    """Repeats × models for one metric; a duplicated (repeat, model) fails the job."""
    v = F.col(metric)
    cell = F.when(F.count(F.lit(1)) > 1,
                  F.raise_error(F.lit("duplicate (repeat, model) in metric table"))
                  ).otherwise(F.first(v)).cast("double")
    return metrics.groupBy("repeat").pivot("model", list(models)).agg(cell)


def _order_pos(model_order: Sequence[str] | None) -> F.Column:
    if not model_order:
        return F.lit(0)
    at = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
    return F.coalesce(F.nullif(at, F.lit(0).cast("long")), F.lit(len(model_order) + 1).cast("long"))  # unknown models come last


def best_run(metrics: DataFrame, metric: str = "macro_f1",
             model_order: Sequence[str] | None = None) -> DataFrame:
    """A10: the single best (model, repeat); the earliest repeat, then the
    earliest model in run order, wins ties (strict ``>`` scan)."""
    w = Window.orderBy(F.desc(metric), "repeat", _order_pos(model_order), "model")
    return (metrics.select("model", "repeat", metric)
            .withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r"))


def best_worst_per_metric(summary: DataFrame) -> DataFrame:
    """Best and worst model per metric from the summary, direction aware
    (lower Brier is better); the first model in name order wins ties."""
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    goodness = F.when(lower, -F.col("mean")).otherwise(F.col("mean"))
    wb = Window.partitionBy("metric").orderBy(F.desc("_g"), "model")
    ww = Window.partitionBy("metric").orderBy(F.asc("_g"), "model")
    s = summary.select("model", "metric", "mean").withColumn("_g", goodness)
    s = s.withColumn("_b", F.row_number().over(wb)).withColumn("_w", F.row_number().over(ww))
    return s.groupBy("metric").agg(
        F.max(F.when(F.col("_b") == 1, F.col("model"))).alias("best_model"),
        F.max(F.when(F.col("_b") == 1, F.col("mean"))).alias("best_mean"),
        F.max(F.when(F.col("_w") == 1, F.col("model"))).alias("worst_model"),
        F.max(F.when(F.col("_w") == 1, F.col("mean"))).alias("worst_mean"))


def model_ranking(metrics: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """T1 + W9 + C11: models by mean metric (desc) with a 1-based ordinal,
    sample std and the comparison-chart axis bounds."""
    s = metrics.groupBy("model").agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"))
    allw = Window.partitionBy(F.lit(1))
    return (s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean"), "model")))
            .withColumn("axis_min", F.greatest(F.lit(0.0), F.min("mean").over(allw) - 0.1))
            .withColumn("axis_max", F.least(F.lit(1.0), F.max("mean").over(allw) + 0.1)))


def learning_curve(metrics: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Running mean and running sample std over repeats per model."""
    w = Window.partitionBy("model").orderBy("repeat").rowsBetween(Window.unboundedPreceding, 0)
    return metrics.select("model", "repeat",
                          F.avg(metric).over(w).alias("running_mean"),
                          F.stddev_samp(metric).over(w).alias("running_std"))


def box_stats(metrics: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Quartiles (interpolated), mean, 1.5·IQR whiskers and outlier count."""
    q = metrics.groupBy("model").agg(
        F.percentile(metric, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.avg(metric).alias("mean"), F.min(metric).alias("min"), F.max(metric).alias("max"))
    q = q.select("model", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"), "mean", "min", "max")
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col(metric)
    j = metrics.select("model", metric).join(q, "model")
    return j.groupBy("model", "q1", "median", "q3", "mean", "min", "max").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count(F.when((v < lo) | (v > hi), v)).alias("n_outliers"))


def ideal_quadrant(metrics: DataFrame, metric: str = "macro_f1", fallback: int = 4) -> DataFrame:
    """Models with mean ≥ median(mean) and std ≤ median(std); when no
    model qualifies, the ``fallback`` models with the smallest std."""
    s = metrics.groupBy("model").agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"))
    allw = Window.partitionBy(F.lit(1))
    s = (s.withColumn("_mm", F.median("mean").over(allw)).withColumn("_ms", F.median("std").over(allw))
         .withColumn("ideal", (F.col("mean") >= F.col("_mm")) & (F.col("std") <= F.col("_ms"))))
    s = (s.withColumn("_any", F.max(F.col("ideal").cast("int")).over(allw))
         .withColumn("_rs", F.row_number().over(Window.orderBy("std", "model"))))
    keep = F.when(F.col("_any") == 1, F.col("ideal")).otherwise(F.col("_rs") <= fallback)
    return s.filter(keep).select("model", "mean", "std", F.col("ideal"))


def top_plus_named(metrics: DataFrame, metric: str = "macro_f1", k: int = 3,
                   named: str = "Ensemble") -> DataFrame:
    """T5: the k best models by mean plus a named model when it is not among them."""
    s = metrics.groupBy("model").agg(F.avg(metric).alias("mean"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean"), "model")))
    return s.filter((F.col("rank") <= k) | (F.col("model") == named))


def rank_slices(metrics: DataFrame) -> DataFrame:
    """T6 (+ P17): named slices of the model ranking —
    top-3 / bottom-2 by ROC-AUC, four most / least stable by macro-F1 std,
    2nd–4th after the leader by macro-F1, and the second-worst mean macro-F1
    once the worst is dropped."""
    s = metrics.groupBy("model").agg(F.avg("roc_auc").alias("auc"), F.avg("macro_f1").alias("mf1"),
                                     F.stddev_samp("macro_f1").alias("sd"))
    s = (s.withColumn("auc_desc", F.row_number().over(Window.orderBy(F.desc("auc"), "model")))
         .withColumn("auc_asc", F.row_number().over(Window.orderBy(F.asc("auc"), "model")))
         .withColumn("sd_asc", F.row_number().over(Window.orderBy(F.asc("sd"), "model")))
         .withColumn("sd_desc", F.row_number().over(Window.orderBy(F.desc("sd"), "model")))
         .withColumn("f1_desc", F.row_number().over(Window.orderBy(F.desc("mf1"), "model")))
         .withColumn("f1_asc", F.row_number().over(Window.orderBy(F.asc("mf1"), "model"))))
    sl = F.explode(F.array(
        F.when(F.col("auc_desc") <= 3, F.lit("top3_auc")),
        F.when(F.col("auc_asc") <= 2, F.lit("bottom2_auc")),
        F.when(F.col("sd_asc") <= 4, F.lit("most_stable4")),
        F.when(F.col("sd_desc") <= 4, F.lit("least_stable4")),
        F.when(F.col("f1_desc").between(2, 4), F.lit("runners_up")),
        F.when(F.col("f1_asc") == 2, F.lit("second_worst"))))
    return s.select("model", sl.alias("slice")).filter(F.col("slice").isNotNull())


def auc_legend(metrics: DataFrame) -> DataFrame:
    """Mean ± population std (ddof 0) of ROC-AUC and PR-AUC per model."""
    return metrics.groupBy("model").agg(
        F.avg("roc_auc").alias("auc_mean"), F.stddev_pop("roc_auc").alias("auc_std"),
        F.avg("pr_auc").alias("ap_mean"), F.stddev_pop("pr_auc").alias("ap_std"))
