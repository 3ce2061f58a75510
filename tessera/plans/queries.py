"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over the whole driver tables.  Double outputs are rounded to
9 places so they compare engine-neutrally with the SQL twins in
``tessera.plans.oracle``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import round_doubles
from tessera.operators import metrics as M
from tessera.operators import report as R
from tessera.operators import stats as S
from tessera.sources import bindings as B

CELL = ["model", "repeat"]


def q_nine_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = B.pred_scores(spark, sf_dir).withColumn("y_pred", (F.col("proba") >= 0.5).cast("int"))
    return round_doubles(M.binary_metrics(pred, CELL))


def q_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(M.best_threshold(B.pred_scores(spark, sf_dir), CELL))


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine metrics per (model, repeat) at each cell's F1-best threshold."""
    return M.metrics_at_best_threshold(B.pred_scores(spark, sf_dir), CELL)


def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(metrics_long(spark, sf_dir))


PRED_MODELS = [f"M{i}" for i in range(1, 8)]


def _m(spark, sf_dir):
    """The metric table (full precision) — input of every report query."""
    return metrics_long(spark, sf_dir)


def q_metric_summary(spark, sf_dir):
    return round_doubles(R.metric_summary(_m(spark, sf_dir)))


def q_metric_pivot(spark, sf_dir):
    return round_doubles(R.metric_pivot(_m(spark, sf_dir), "macro_f1", PRED_MODELS))


def q_best_run(spark, sf_dir):
    return round_doubles(R.best_run(_m(spark, sf_dir), "macro_f1"))


def q_best_worst(spark, sf_dir):
    return round_doubles(R.best_worst_per_metric(R.metric_summary(_m(spark, sf_dir))))


def q_model_ranking(spark, sf_dir):
    return round_doubles(R.model_ranking(_m(spark, sf_dir)))


def q_learning_curve(spark, sf_dir):
    return round_doubles(R.learning_curve(_m(spark, sf_dir)))


def q_box_stats(spark, sf_dir):
    return round_doubles(R.box_stats(_m(spark, sf_dir)))


def q_ideal_quadrant(spark, sf_dir):
    return round_doubles(R.ideal_quadrant(_m(spark, sf_dir)))


def q_top3_plus_named(spark, sf_dir):
    return round_doubles(R.top_plus_named(_m(spark, sf_dir), named="M1"))


def q_rank_slices(spark, sf_dir):
    return R.rank_slices(_m(spark, sf_dir))


def q_auc_legend(spark, sf_dir):
    return round_doubles(R.auc_legend(_m(spark, sf_dir)))


def q_friedman(spark, sf_dir):
    return round_doubles(S.friedman(_m(spark, sf_dir)))


def q_wilcoxon_pairs(spark, sf_dir):
    return round_doubles(S.wilcoxon_pairs(_m(spark, sf_dir)))


def q_significant_pairs(spark, sf_dir):
    w = S.wilcoxon_pairs(_m(spark, sf_dir))
    return w.agg(F.count(F.lit(1)).alias("n_pairs"),
                 F.sum(F.col("significant").cast("long")).alias("n_significant"))


REGISTRY = {
    "nine_metrics": q_nine_metrics,
    "best_threshold": q_best_threshold,
    "metrics_long": q_metrics_long,
    "metric_summary": q_metric_summary,
    "metric_pivot": q_metric_pivot,
    "best_run": q_best_run,
    "best_worst_per_metric": q_best_worst,
    "model_ranking": q_model_ranking,
    "learning_curve": q_learning_curve,
    "box_stats": q_box_stats,
    "ideal_quadrant": q_ideal_quadrant,
    "top3_plus_named": q_top3_plus_named,
    "rank_slices": q_rank_slices,
    "auc_legend": q_auc_legend,
    "friedman": q_friedman,
    "wilcoxon_pairs": q_wilcoxon_pairs,
    "significant_pairs": q_significant_pairs,
}


# ---------------------------------------------------------------- data + splits
from tessera.operators import data as D  # noqa: E402
from tessera.operators import splits as SP  # noqa: E402
from tessera.sources.tables import read_table  # noqa: E402


def _wide(spark, sf_dir, derived=False):
    return B.wide_samples(spark, sf_dir, derived)


def q_union_sources(spark, sf_dir):
    w = _wide(spark, sf_dir).withColumn("PatientIndex", (F.col("row_id") % B.WIDE_GROUPS).cast("int"))
    srcs = {"N": (w.filter("label = 0").drop("label", "patient_id"), 0),
            "P": (w.filter("label = 1").drop("label", "patient_id"), 1)}
    return D.union_sources(srcs).select("row_id", "patient_id", "label", "side")


def q_inf_to_null(spark, sf_dir):
    raw = _wide(spark, sf_dir).select("row_id", F.posexplode("features").alias("pos", "raw"))
    clean = D.inf_to_null(_wide(spark, sf_dir)).select("row_id", F.posexplode("features").alias("pos", "value"))
    j = raw.join(clean, ["row_id", "pos"])
    out = j.groupBy((F.col("pos") + 1).alias("feature_idx")).agg(
        F.count(F.when(F.col("value").isNull(), 1)).alias("n_missing"),
        F.count(F.when(F.col("raw").isNotNull() & F.col("value").isNull(), 1)).alias("n_replaced"),
        F.sum("value").alias("finite_sum"))
    return round_doubles(out)


def q_one_hot_side(spark, sf_dir):
    df, names = D.one_hot(_wide(spark, sf_dir), "side", ["Left", "Right"])
    return df.select("row_id", *names)


def q_integrity_overlap(spark, sf_dir):
    return D.label_overlap(B.mixed_events(spark, sf_dir), "group_id")


def q_integrity_mixed_label(spark, sf_dir):
    return D.mixed_label_groups(B.mixed_events(spark, sf_dir), "group_id")


def q_group_size_deviants(spark, sf_dir):
    return D.group_size_deviants(_wide(spark, sf_dir))


def q_class_distribution(spark, sf_dir):
    return round_doubles(D.class_distribution(_wide(spark, sf_dir)))


def wide_split(spark, sf_dir):
    return SP.group_split(_wide(spark, sf_dir))


def q_group_split(spark, sf_dir):
    return wide_split(spark, sf_dir)


def q_nested_val_split(spark, sf_dir):
    return wide_split(spark, sf_dir).groupBy("repeat", "split").agg(F.count(F.lit(1)).alias("n_groups"))


def q_groups_tall_split(spark, sf_dir):
    """Rows are counted by group before the repeats, so no row is copied."""
    tall = B.groups_tall(spark, sf_dir)
    sizes = tall.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos"))
    a = SP.group_split(sizes, "group_id")
    return SP.assign_rows(sizes, a, "group_id").groupBy("repeat", "split").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"))


LEAKY_REPEATS = 20


def q_leakage_check(spark, sf_dir):
    groups = B.groups_tall(spark, sf_dir).select("group_id").distinct()
    grp = SP.assign_rows(groups, SP.group_split(groups, "group_id"), "group_id")
    v_grp = SP.leakage_violations(grp, "group_id")
    # what each row hashes besides the repeat is made once, and a group keeps the set of its repeats in each split
    own = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(own != "", own).alias("own"))
    rows = li.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(LEAKY_REPEATS - 1))))
    h = F.md5(F.concat_ws(":", F.lit("42"), F.col("repeat").cast("string"), F.col("own")))
    bit, in_test = F.expr("shiftleft(1L, repeat)"), F.substring(h, 1, 1).isin("0", "1", "2")
    seen = rows.withColumn("in_test", in_test).groupBy("l_suppkey").agg(
        F.bit_or(F.when(F.col("in_test"), bit)).alias("test"), F.bit_or(F.when(~F.col("in_test"), bit)).alias("train"))
    leaky = seen.select(F.col("l_suppkey").cast("string").alias("group_id"), F.explode(F.create_map(
        F.lit("test"), F.coalesce("test", F.lit(0)), F.lit("train"), F.coalesce("train", F.lit(0)))).alias("split", "repeats"))
    leaky = leaky.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(LEAKY_REPEATS - 1)))).filter(F.expr("getbit(repeats, repeat) = 1"))
    v_row = SP.leakage_violations(leaky, "group_id")
    return (v_grp.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit("group").alias("kind"), "n_violations")
            .unionByName(v_row.agg(F.count(F.lit(1)).alias("n_violations"))
                         .select(F.lit("row").alias("kind"), "n_violations")))


def q_stratified_group_kfold(spark, sf_dir):
    w = _wide(spark, sf_dir)
    return SP.stratified_group_kfold(w, SP.group_split(w), k=5)


def q_class_weights(spark, sf_dir):
    from tessera.operators.models import class_weights
    w = _wide(spark, sf_dir)
    tr = SP.assign_rows(w, SP.group_split(w)).filter(F.col("split") == "train")
    return round_doubles(class_weights(tr, by=["repeat"]).groupBy("repeat", "label").agg(
        F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight")))


def q_pending_cells(spark, sf_dir):
    from tessera.plans.run import pending_cells, run_grid
    done = B.pred_scores(spark, sf_dir).select("model", "repeat").distinct()
    grid = run_grid(spark, 20, PRED_MODELS + ["Ensemble"])
    return pending_cells(grid, done)


REGISTRY.update({
    "union_sources": q_union_sources,
    "inf_to_null": q_inf_to_null,
    "one_hot_side": q_one_hot_side,
    "integrity_overlap": q_integrity_overlap,
    "integrity_mixed_label": q_integrity_mixed_label,
    "group_size_deviants": q_group_size_deviants,
    "class_distribution": q_class_distribution,
    "group_split": q_group_split,
    "nested_val_split": q_nested_val_split,
    "groups_tall_split": q_groups_tall_split,
    "leakage_check": q_leakage_check,
    "stratified_group_kfold": q_stratified_group_kfold,
    "class_weights": q_class_weights,
    "pending_cells": q_pending_cells,
})


# ---------------------------------------------------------------- preparation
from tessera.operators import prep as P  # noqa: E402


def prep_inputs(spark, sf_dir):
    """WIDE with derived features, ±inf → NULL; group split; train cells."""
    w = D.inf_to_null(B.wide_samples(spark, sf_dir, derived=True)).drop("n_nonfinite")
    a = SP.group_split(w)
    cells = a.filter(F.col("split") == "train").select("repeat", "patient_id")
    return w, a, cells


def _prep_stats(spark, sf_dir):
    w, a, cells = prep_inputs(spark, sf_dir)
    long = P.to_long(P.fit_rows(w, cells, ["repeat"]), ["repeat"])
    med = P.medians(long, ["repeat"])
    return med, P.variance_filter(P.imputed_stats(long, med, ["repeat"]))


def q_median_impute(spark, sf_dir):
    med, _ = _prep_stats(spark, sf_dir)
    return round_doubles(med)


def q_variance_filter(spark, sf_dir):
    _, st = _prep_stats(spark, sf_dir)
    return round_doubles(st.select("repeat", "feature_idx", "var_pop", "keep_var"))


def q_corr_edges(spark, sf_dir):
    w, a, cells = prep_inputs(spark, sf_dir)
    _, st = _prep_stats(spark, sf_dir)
    cand = st.filter("keep_var").select("repeat", "feature_idx", "median")
    g = P.gram(P.fit_rows(w, cells, ["repeat"]), ["repeat"], cand)
    return round_doubles(P.corr_edges(P.correlations(g, ["repeat"])))


def _prep_model(spark, sf_dir):
    w, a, cells = prep_inputs(spark, sf_dir)
    return w, a, P.FeaturePrep(["repeat"]).fit(w, cells)


def q_corr_filter(spark, sf_dir):
    _, _, m = _prep_model(spark, sf_dir)
    return m.params.filter("keep").select("repeat", "feature_idx")


def q_robust_scale(spark, sf_dir):
    _, _, m = _prep_model(spark, sf_dir)
    return round_doubles(m.params.filter("keep").select("repeat", "feature_idx", "center", "scale"))


def q_prep_transform(spark, sf_dir):
    w, a, m = _prep_model(spark, sf_dir)
    rows = SP.assign_rows(w, a)
    x = m.transform(rows).select("repeat", "split", F.posexplode("x").alias("position", "v"))
    return round_doubles(x.groupBy("repeat", "split", "position").agg(
        F.sum("v").alias("x_sum"), F.count(F.lit(1)).alias("n")))


def q_feature_lineage(spark, sf_dir):
    _, _, m = _prep_model(spark, sf_dir)
    names = B.wide_feature_names(spark, derived=True)
    return m.support().join(F.broadcast(names), "feature_idx").select(
        "repeat", "position", "feature_idx", "feature_name")


REGISTRY.update({
    "median_impute": q_median_impute,
    "variance_filter": q_variance_filter,
    "corr_edges": q_corr_edges,
    "corr_filter": q_corr_filter,
    "robust_scale": q_robust_scale,
    "prep_transform": q_prep_transform,
    "feature_lineage": q_feature_lineage,
})


# ---------------------------------------------------------------- curves
def q_roc_curve(spark, sf_dir):
    c = M.mean_curve(B.pred_scores(spark, sf_dir), "roc")
    return round_doubles(c.select("model", "k", "x", "y"))


def q_pr_curve(spark, sf_dir):
    c = M.mean_curve(B.pred_scores(spark, sf_dir), "pr")
    return round_doubles(c.select("model", "k", "x", "y"))


def q_calibration_curve(spark, sf_dir):
    return round_doubles(M.calibration_curve(B.pred_scores(spark, sf_dir), ["model"]))


def q_confusion_matrix(spark, sf_dir):
    cm = M.confusion_at_best_threshold(B.pred_scores(spark, sf_dir), CELL)
    return cm.select("model", "repeat", F.col("y_true").cast("int"), F.col("y_pred").cast("int"), "n")


REGISTRY.update({
    "roc_curve": q_roc_curve,
    "pr_curve": q_pr_curve,
    "calibration_curve": q_calibration_curve,
    "confusion_matrix": q_confusion_matrix,
})


# ---------------------------------------------------------------- selection
from tessera.operators import models as MD  # noqa: E402
from tessera.operators import select as SEL  # noqa: E402


def imputed_long_whole(spark, sf_dir, derived=False):
    """WIDE long view, ±inf → NULL, imputed with whole-table medians."""
    lg = B.wide_long(spark, sf_dir, derived).withColumn(
        "value", F.when(F.abs("value") == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(F.col("value")))
    med = lg.groupBy("feature_idx").agg(F.percentile("value", 0.5).alias("_m"))
    return lg.join(med, "feature_idx").withColumn("x", F.coalesce("value", "_m")).drop("_m")


def q_mi_knn(spark, sf_dir):
    return round_doubles(SEL.mutual_info_knn(imputed_long_whole(spark, sf_dir), []))


def q_mi_binned(spark, sf_dir):
    return round_doubles(SEL.mutual_info_binned(imputed_long_whole(spark, sf_dir), []))


MRMR_QUERY_K = max(MD.MRMR_K_CHOICES)
STABILITY_K = 20


def mrmr_selection(spark, sf_dir, k=MRMR_QUERY_K):
    """Per repeat: fold-safe prep on train rows, MI relevance of the kept
    features on imputed train values, MRMR over the kept set: the largest k of
    the search space, capped at the kept features."""
    w, a, cells = prep_inputs(spark, sf_dir)
    m = P.FeaturePrep(["repeat"]).fit(w, cells)
    kept = m.params.filter("keep").select("repeat", "feature_idx", "median")
    labels = B.wide_samples(spark, sf_dir).select("row_id", "label")
    fit = P.fit_rows(w.drop("label").join(labels, "row_id"), cells, ["repeat"])
    long = fit.select("repeat", "label", F.posexplode("features").alias("_p", "value")).withColumn("feature_idx", F.col("_p") + 1)
    long = long.join(F.broadcast(kept), ["repeat", "feature_idx"]).withColumn("x", F.coalesce("value", "median"))  # cells x features rows
    rel = SEL.mutual_info_knn(long, ["repeat"])
    corr = m.corr.join(kept.select("repeat", F.col("feature_idx").alias("i")), ["repeat", "i"]) \
        .join(kept.select("repeat", F.col("feature_idx").alias("j")), ["repeat", "j"])
    return SEL.mrmr(rel, corr, ["repeat"], k)


def q_mrmr_topk(spark, sf_dir):
    return round_doubles(mrmr_selection(spark, sf_dir))


def q_selection_stability(spark, sf_dir):
    sel = mrmr_selection(spark, sf_dir).filter(F.col("step") < STABILITY_K)  # the prefix is the selection for STABILITY_K
    names = B.wide_feature_names(spark, derived=True)
    return round_doubles(SEL.selection_stability(sel).join(F.broadcast(names), "feature_idx"))


REGISTRY.update({
    "mi_knn": q_mi_knn,
    "mi_binned": q_mi_binned,
    "mrmr_topk": q_mrmr_topk,
    "selection_stability": q_selection_stability,
})


# ---------------------------------------------------------------- models, calibration, run
from tessera.operators import calibrate as CAL  # noqa: E402


def q_soft_vote(spark, sf_dir):
    """C4 + C5: soft vote of M5..M7 per scored row (rows aligned on the
    lineitem key, no join), then the nine metrics of the ensemble."""
    pred = B.pred_scores(spark, sf_dir, row_key=True)
    ens = CAL.soft_vote(pred, ["M5", "M6", "M7"], ["repeat", "group_id", "y_true", *B.ROW_KEY])
    # the mean of three scores is stored at 1e-12 resolution, so equal means tie exactly
    ens = ens.withColumn("proba", F.round("proba", 12)).withColumn("y_pred", (F.col("proba") >= 0.5).cast("int"))
    return round_doubles(M.binary_metrics(ens, CELL))


def q_platt_fit(spark, sf_dir):
    """Platt fit per (model, repeat) on the PRED scores: ``a`` and ``b``, the mean
    gradient there, which is zero at the optimum, and the convergence flag."""
    pred = B.pred_scores(spark, sf_dir).withColumnRenamed("proba", "score")
    fit = CAL.platt_fit(pred, CELL, grad_tol=1e-9)  # nearly separable cells are flat: a looser end shows in a and b
    zero = lambda c: (F.round(c, 9) + F.lit(0.0)).alias(c)  # noqa: E731  (no negative zero)
    return fit.select(*CELL, F.round("a", 5).alias("a"), F.round("b", 5).alias("b"), zero("grad_a"), zero("grad_b"), "converged")


def q_sigmoid_apply(spark, sf_dir):
    """C3 (+ P9/P10): calibrated probabilities under given parameters (they
    differ by repeat); summary per cell."""
    pred = B.pred_scores(spark, sf_dir).withColumnRenamed("proba", "score")
    params = pred.select(*CELL).distinct().withColumn("a", -4.0 - F.col("repeat") / 10).withColumn("b", F.lit(2.0))
    cal = CAL.platt_apply(pred, params, CELL, s="score")
    return round_doubles(cal.groupBy(*CELL).agg(
        F.avg("proba").alias("mean_proba"), F.min("proba").alias("min_proba"),
        F.max("proba").alias("max_proba"),
        F.max(F.abs(F.col("proba_pair")[0] + F.col("proba_pair")[1] - 1)).alias("pair_err")))


def q_random_search(spark, sf_dir):
    """LR, SVM and extra-trees searched on the whole WIDE table, five
    trials on three grouped folds: the best trial of each model, its parameters,
    its mean macro-F1 over the folds, and whether its fits converged."""
    from tessera.plans.run import Run, RunConfig, best_parameters
    w, _, _ = prep_inputs(spark, sf_dir)
    run = Run(spark, w, RunConfig(n_repeats=1, n_trials=5, n_folds=3, models=("LR", "SVM", "ET"), ensemble_members=()))
    run.prepare()
    return round_doubles(best_parameters(run, run.search()))


def q_full_run(spark, sf_dir):
    """The grouped evaluation at the reference's smoke configuration
    (2 repeats, 3 trials, 3 inner folds) on the whole WIDE table: test metrics per
    (model, repeat) of the six models and the soft-voting ensemble of RF, ET and
    GB at its own threshold (C5, U4), and whether the refit converged."""
    from tessera.plans.run import RunConfig, run_evaluation
    w, _, _ = prep_inputs(spark, sf_dir)
    return round_doubles(run_evaluation(spark, w, RunConfig.smoke())["metrics"])


def q_shap_top10(spark, sf_dir):
    """X2 / A18 / T4 (J8 for the names): the ten features of the largest mean
    |contribution| over the test rows of the first split, and the largest gap
    between a row's output and its base plus contributions."""
    from tessera.plans.run import RunConfig, explain_run
    w, _, _ = prep_inputs(spark, sf_dir)
    found = explain_run(spark, w, RunConfig())
    gap = F.abs(F.col("base") + F.aggregate("phi", F.lit(0.0), lambda t, v: t + v) - F.col("output"))
    rows = found["contributions"].agg(F.count(F.lit(1)).alias("n_rows"), F.max(gap).alias("max_gap"))
    names = B.wide_feature_names(spark, derived=True)
    from tessera.functions.exprs import attach_scalar
    top = found["top"].join(F.broadcast(names), "feature_idx").select("rank", "feature_idx", "feature_name", "mean_abs")
    return round_doubles(attach_scalar(top, rows))


KNN_QUERY_K = 5


def q_knn_score(spark, sf_dir):
    """M6: every WIDE row scored by its five nearest other rows, for both
    weights and both metrics (missing and infinite values as 0)."""
    w = B.wide_samples(spark, sf_dir)
    finite = lambda v: F.coalesce(F.when(F.abs(v) == float("inf"), F.lit(None)).otherwise(v), F.lit(0.0))
    w = w.select("row_id", "label", F.transform("features", finite).alias("xs"))
    files, found, metrics = MD.training_files(w), MD.spread(w), ("euclidean", "manhattan")
    for metric in metrics:
        found = MD.nearest_rows(w, found, KNN_QUERY_K, metric, exclude_self=True, out=f"_{metric}", files=files)
    for weights in ("uniform", "distance"):
        for metric in metrics:
            found = MD.knn_scores_exact(w, found, KNN_QUERY_K, weights, metric, exclude_self=True, out=f"{weights}_{metric}", near=f"_{metric}")
    return round_doubles(found.drop("xs", *[f"_{m}" for m in metrics]))


REGISTRY.update({
    "knn_score": q_knn_score,
    "soft_vote": q_soft_vote,
    "platt_fit": q_platt_fit,
    "sigmoid_apply": q_sigmoid_apply,
    "random_search": q_random_search,
    "shap_top10": q_shap_top10,
    "full_run": q_full_run,
})
