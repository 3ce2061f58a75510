"""Run-level plans: the experiment grid, resumable bookkeeping and the full
grouped evaluation (split → fold-safe prep → MRMR → search → out-of-fold
Platt calibration → threshold on validation → test metrics → soft vote).

Everything that touches rows is a batched DataFrame job over all cells.  All
fits of a model (trials × repeats × folds) are one step: fit programs over
blocks of rows (``operators.cells``), whose number of jobs does not depend on the
number of fits.  The steps of all models run at once.  A step's scores and its seconds are committed to the run's
directory, which is named by a fingerprint of configuration and input; a
restarted run reads its tables and skips finished steps.
"""
from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import DEFAULT_SEED, ENSEMBLE_MEMBERS, MODEL_ORDER
from tessera.operators import calibrate as C
from tessera.operators import cells as CE
from tessera.operators import explain as EX
from tessera.operators import metrics as M
from tessera.operators import models as MD
from tessera.operators import prep as P
from tessera.operators import report as RP
from tessera.operators import select as SEL
from tessera.operators import splits as SP
from tessera.operators import stats as ST
from tessera.session import ensure_checkpoint_dir
from tessera.sources.sinks import write_json_document


def run_grid(spark: SparkSession, n_repeats: int, models: Sequence[str]) -> DataFrame:
    """One row per (repeat, model) cell (a generated table, no join)."""
    return (spark.range(n_repeats).select(F.col("id").cast("int").alias("repeat"))
            .withColumn("model", F.explode(F.array(*[F.lit(m) for m in models]))))


def pending_cells(grid: DataFrame, done: DataFrame, keys: Sequence[str] = ("repeat", "model")) -> DataFrame:
    """Cells of the grid that have no finished result yet."""
    return grid.join(done.select(*keys), list(keys), "left_anti")


@dataclass
class RunConfig:
    """Knobs of an evaluation run (reference defaults: 20 repeats,
    50 trials, 5 folds; the smoke configuration is 2 / 3 / 3)."""
    n_repeats: int = 20
    n_trials: int = 50
    n_folds: int = 5
    models: tuple = MD.MODELS
    ensemble_members: tuple = ENSEMBLE_MEMBERS
    seed: int = DEFAULT_SEED
    parallelism: int = 8
    block_rows: int = CE.BLOCK_ROWS  # rows of a block
    whole_bytes: int = CE.WHOLE_BYTES  # features of a cell that one task may hold; fits of larger cells run in lockstep over their blocks
    mrmr_k_max: int = 100
    max_iter: int = MD.MAX_ITER  # steps of LR and SVM; the results tell which fits needed more
    group: str = "patient_id"
    out_dir: str | None = None
    extra: dict = field(default_factory=dict)

    @classmethod
    def smoke(cls, **kw) -> "RunConfig":
        return cls(n_repeats=2, n_trials=3, n_folds=3, **kw)


def fingerprint(samples: DataFrame, cfg: RunConfig) -> str:
    """Names a run by its configuration and its input rows (order-free)."""
    knobs = {k: v for k, v in vars(cfg).items() if k not in ("out_dir", "parallelism", "block_rows", "whole_bytes", "extra")}
    rows = samples.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*samples.columns).cast("decimal(38,0)")).alias("h")).first()
    text = json.dumps([knobs, samples.dtypes, rows["n"], str(rows["h"])], sort_keys=True, default=list)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def _run_dir(spark: SparkSession, cfg: RunConfig, mark: str) -> str:
    """The run's folder: below ``out_dir`` or the shared checkpoint folder, and
    named by the fingerprint, so a changed input or configuration never meets
    the tables of another run."""
    base = cfg.out_dir or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/run-{mark}"


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written before, or None if there is none; other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _kept(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path``, made and written first unless it is there."""
    if _table(spark, path) is None:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def design_table(samples: DataFrame, cfg: RunConfig):
    """Splits, folds, fold-safe preparation and MRMR for every (repeat, fold)
    cell, and the design rows.  fold = −1 is the whole training part of a repeat
    (final refit)."""
    g = cfg.group
    samples = samples.checkpoint()
    a = SP.group_split(samples, g, cfg.n_repeats, seed=cfg.seed).checkpoint()
    folds = SP.stratified_group_kfold(samples, a, g, k=cfg.n_folds, seed=cfg.seed)
    roles_cv = SP.fold_cells(folds, cfg.n_folds, g)
    roles_full = a.select("repeat", g, F.lit(-1).alias("fold"),
                          F.when(F.col("split") == "train", F.lit("fit")).otherwise(F.col("split")).alias("role"))
    roles = roles_cv.unionByName(roles_full).checkpoint()
    prep, sel, design = design_rows(samples, roles, cfg)
    return a, roles, prep, sel, design


def design_rows(samples: DataFrame, roles: DataFrame, cfg: RunConfig):
    """Preparation, selections and design rows ``(repeat, fold, role, row_id,
    label, weight, xs)`` of the cells in ``roles`` ``(repeat, fold, <group>, role)``;
    all is fitted on role ``fit``, and ``xs`` are the prepared features in MRMR order."""
    g, cc = cfg.group, ["repeat", "fold"]
    cells = roles.filter(F.col("role") == "fit").select(*cc, g)
    prep = P.FeaturePrep(cc, g).fit(samples, cells)
    kept = prep.params.filter("keep").select(*cc, "feature_idx", "median")
    fit = P.fit_rows(samples, cells, cc, g)
    long = (fit.select(*cc, "row_id", "label", F.posexplode("features").alias("_p", "value"))
            .select(*cc, "row_id", "label", (F.col("_p") + 1).alias("feature_idx"), "value")
            .join(F.broadcast(kept), [*cc, "feature_idx"]).withColumn("x", F.coalesce("value", "median")))  # cells x features rows
    rel = SEL.mutual_info_knn(long, cc).checkpoint()
    corr = (prep.corr.join(kept.select(*cc, F.col("feature_idx").alias("i")), [*cc, "i"])
            .join(kept.select(*cc, F.col("feature_idx").alias("j")), [*cc, "j"]))
    sel = SEL.mrmr(rel, corr, cc, cfg.mrmr_k_max).checkpoint()
    order = sel.groupBy(*cc).agg(F.array_sort(F.collect_list(F.struct("step", "feature_idx"))).alias("_s")) \
        .select(*cc, F.col("_s.feature_idx").alias("sel"))
    rows = samples.join(roles, g)
    t = prep.transform(rows).join(F.broadcast(order), cc)  # one row for each cell
    xs = F.transform("sel", lambda f: F.col("x")[F.array_position("support", f) - 1])
    design = t.select(*cc, "role", g, "row_id", "label", xs.alias("xs"))
    w = MD.class_weights(design.filter(F.col("role") == "fit"), cc, "label").select(*cc, "row_id", "weight")
    design = design.join(w, [*cc, "row_id"], "left").fillna({"weight": 1.0}).cache()
    return prep, sel, design


class Run:
    """The tables and the log of one run folder."""

    def __init__(self, spark: SparkSession, samples: DataFrame, cfg: RunConfig):
        self.spark, self.samples, self.cfg = spark, samples, cfg
        self.out, self.attempt = _run_dir(spark, cfg, fingerprint(samples, cfg)), uuid.uuid4().hex
        self._made: dict[str, DataFrame] = {}
        self._lock, self._ended = threading.Lock(), 0.0

    def log(self, step: str, model: str, fits: int, seconds: float) -> None:
        row = [(self.attempt, step, model, fits, float(seconds))]
        self.spark.createDataFrame(row, "attempt string, step string, model string, fits int, seconds double").coalesce(1).write.mode("append").parquet(f"{self.out}/log")

    def _design(self, name: str) -> DataFrame:
        if not self._made:  # only a run that lacks one of its tables computes the design
            a, _, _, sel, design = design_table(self.samples, self.cfg)
            self._made.update(assignments=a, selections=sel, design=design)
        return self._made[name]

    def prepare(self) -> None:
        """Assignments, selections, and the design rows and their blocks: written
        once, read by every step and every resumed run."""
        t0, cc, size = time.time(), ["repeat", "fold"], self.cfg.block_rows
        self.assignments = _kept(self.spark, f"{self.out}/assignments", lambda: self._design("assignments"))
        self.selections = _kept(self.spark, f"{self.out}/selections", lambda: self._design("selections"))
        self.design = _kept(self.spark, f"{self.out}/design", lambda: self._design("design"))
        fit = F.col("role") == "fit"
        self.fit_blocks = _kept(self.spark, f"{self.out}/blocks-{size}/fit", lambda: CE.block_table(self.design.filter(fit), cc, block_rows=size))
        self.out_blocks = _kept(self.spark, f"{self.out}/blocks-{size}/out", lambda: CE.block_table(self.design.filter(~fit), [*cc, "role"], block_rows=size))
        if self._made:
            self._made["design"].unpersist()
            self.log("prepare", "", 0, time.time() - t0)

    def scores(self, step: str, model: str, tasks: list[tuple], roles: Sequence[str]) -> None:
        """Fit and score ``tasks`` = (trial, repeat, fold) → params of one model, unless it is done."""
        path = f"{self.out}/{step}_scores/model={model}"
        if _table(self.spark, path) is not None:
            return
        t0 = time.time()
        rows = [(k, repeat, fold, model, json.dumps(params)) for k, ((_, repeat, fold), params) in enumerate(tasks)]
        fits = self.spark.createDataFrame(rows, "fit int, repeat int, fold int, program string, params string")
        if model == "KNN":
            scored = MD.knn_cells(self.fit_blocks, self.out_blocks.where(F.col("role").isin(*roles)), fits, ["repeat", "fold"])
        else:
            models = CE.fit_cells(self.fit_blocks, fits, ["repeat", "fold"], MD.PROGRAMS, self.cfg.seed, self.cfg.whole_bytes, hasattr(MD.PROGRAMS[model], "members"))
            models.write.mode("overwrite").parquet(f"{self.out}/{step}_models/model={model}")
            models = self.spark.read.parquet(f"{self.out}/{step}_models/model={model}")
            scored = CE.score_cells(self.out_blocks, fits, models, ["repeat", "fold"], MD.SCORERS)
        named = self.spark.createDataFrame([(k, trial) for k, ((trial, _, _), _) in enumerate(tasks)], "fit int, trial int")
        out = scored.filter(F.col("role").isin(*roles)).join(F.broadcast(named), "fit")  # one row for each fit
        out.select("trial", "repeat", "fold", "role", "row_id", "y_true", "score", "converged").write.mode("overwrite").parquet(path)
        with self._lock:  # of steps that run at once each counts from the end of the one before, so they add up to the clock
            now = time.time()
            seconds, self._ended = now - max(t0, self._ended), now
            self.log(step, model, len(tasks), seconds)

    def all_scores(self, step: str, tasks: dict[str, list[tuple]], roles: Sequence[str]) -> None:
        """``scores`` of all models (their ``tasks``) at once: while the last fits of one
        model run, those of the next have the other cores."""
        with ThreadPoolExecutor(self.cfg.parallelism) as ex:
            for done in [ex.submit(self.scores, step, m, tasks[m], roles) for m in tasks]:
                done.result()

    def search(self) -> DataFrame:
        """The trial table crossed with the grouped folds, scored by B1;
        the best trial of every (model, repeat): ``model, repeat, trial,
        cv_macro_f1, cv_converged``.  The smaller trial number wins ties."""
        cfg = self.cfg
        self.params = {k: {**p, "max_iter": cfg.max_iter} for k, p in MD.trial_params(MD.trial_table(self.spark, cfg.models, cfg.n_trials, cfg.seed)).items()}
        self.all_scores("cv", {m: [((t, r, f), self.params[(m, t)]) for t in range(cfg.n_trials) for r in range(cfg.n_repeats) for f in range(cfg.n_folds)]
                               for m in cfg.models}, ["held"])
        cv = self.spark.read.parquet(f"{self.out}/cv_scores")
        # an SVM margin is taken through the logistic curve: the same order, and 0.5 where the margin is 0
        proba = F.when(F.col("model") == "SVM", 1.0 / (1.0 + F.exp(-F.col("score")))).otherwise(F.col("score"))
        cvp = cv.withColumn("proba", proba).withColumn("y_pred", (F.col("proba") >= 0.5).cast("int"))
        keys = ["model", "trial", "repeat"]
        by_trial = M.binary_metrics(cvp, [*keys, "fold"]).groupBy(*keys).agg(F.avg("macro_f1").alias("cv_macro_f1"))
        # one flag per trial: all its folds converged (NULL: the model takes no such steps)
        flags = cv.groupBy(*keys).agg(F.bool_and("converged").alias("cv_converged"))
        first = F.row_number().over(Window.partitionBy("model", "repeat").orderBy(F.desc("cv_macro_f1"), "trial"))
        best = by_trial.join(flags, keys).withColumn("_r", first).filter("_r = 1").drop("_r")
        return _kept(self.spark, f"{self.out}/best_trials", lambda: best)


def best_parameters(run: Run, best: DataFrame) -> DataFrame:
    """The best trials with their parameters as JSON (models × trials rows are joined)."""
    rows = [(m, t, json.dumps({k: v for k, v in p.items() if k != "max_iter"}, sort_keys=True)) for (m, t), p in run.params.items()]
    return best.join(F.broadcast(run.spark.createDataFrame(rows, "model string, trial int, params string")), ["model", "trial"])


def run_evaluation(spark: SparkSession, samples: DataFrame, cfg: RunConfig) -> dict[str, DataFrame]:
    """The whole grouped evaluation; returns the long metric table,
    test predictions, chosen trials, thresholds, selections and a manifest.

    ``samples``: ``(row_id, <group>, label, features array<double>)`` with
    missing values as NULL and whole ``row_id``."""
    missing = [m for m in cfg.ensemble_members if m not in cfg.models]
    if missing:
        raise ValueError(f"ensemble members without a model in this run: {missing}")
    run = Run(spark, samples, cfg)
    run.prepare()
    best = run.search()
    cell = ["model", "repeat"]

    # ---- out-of-fold scores of the chosen trial → Platt per (model, repeat)
    oof = spark.read.parquet(f"{run.out}/cv_scores").join(best.select("model", "trial", "repeat"), ["model", "trial", "repeat"])
    t0 = time.time()
    platt = _kept(spark, f"{run.out}/platt", lambda: C.platt_fit(oof, cell, y="y_true", s="score"))
    calibrated = time.time() - t0

    # ---- refit on the whole training part, score validation and test
    chosen = best.collect()  # one row for each model and repeat
    run.all_scores("final", {m: [((r.trial, r.repeat, -1), run.params[(m, r.trial)]) for r in chosen if r.model == m] for m in cfg.models}, ["val", "test"])
    final = C.platt_apply(spark.read.parquet(f"{run.out}/final_scores"), platt, cell, s="score")
    t0 = time.time() - calibrated
    shape = ["model", "repeat", "role", "row_id", "y_true", "proba"]

    def predictions() -> DataFrame:
        own = final.select(*shape)
        if not cfg.ensemble_members:
            return own
        return own.unionByName(C.soft_vote(own, cfg.ensemble_members, ["repeat", "role", "row_id", "y_true"]).select(*shape))  # U4

    allp = _kept(spark, f"{run.out}/predictions", predictions)
    thr = M.best_threshold(allp.filter(F.col("role") == "val"), cell)
    test = M.apply_threshold(allp.filter(F.col("role") == "test"), thr, cell)
    # converged: the refit of the chosen trial; NULL for the ensemble and models that take no such steps
    flags = final.groupBy(*cell).agg(F.bool_and("converged").alias("converged"))
    if _table(spark, f"{run.out}/metrics") is None:
        M.binary_metrics(test, cell).join(flags, cell, "left").write.mode("overwrite").parquet(f"{run.out}/metrics")
        run.log("evaluate", "", 0, time.time() - t0)
    metrics = spark.read.parquet(f"{run.out}/metrics")
    if _table(spark, f"{run.out}/manifest_row") is None:
        _manifest(run, metrics).write.mode("overwrite").parquet(f"{run.out}/manifest_row")
    # the seconds of every step of every attempt
    total = spark.read.parquet(f"{run.out}/log").agg(F.round(F.sum("seconds"), 3).alias("seconds"), F.countDistinct("attempt").alias("attempts"))
    manifest = spark.read.parquet(f"{run.out}/manifest_row").crossJoin(total)  # one row each
    write_json_document(manifest, f"{run.out}/manifest.json")
    return {"metrics": metrics, "predictions": test, "best_trials": best_parameters(run, best), "thresholds": thr,
            "platt": platt, "selections": run.selections, "assignments": run.assignments, "manifest": manifest}


# The extra-trees that the explanation fits.
EXPLAINED_MODEL = {"mrmr_k": 50, "n_estimators": 300, "max_depth": 12, "min_samples_leaf": 2, "max_features": "sqrt"}


def explain_run(spark: SparkSession, samples: DataFrame, cfg: RunConfig, params: dict = EXPLAINED_MODEL, n: int = 10) -> dict[str, DataFrame]:
    """X1 / X2 over the first split (G7): extra-trees fitted on its training and
    validation groups together; contributions of its test rows, and the ``n``
    features of the largest mean |contribution|."""
    samples = samples.checkpoint()
    a = SP.group_split(samples, cfg.group, 1, seed=cfg.seed)
    roles = a.select("repeat", cfg.group, F.lit(-1).alias("fold"), F.when(F.col("split") == "test", F.lit("test")).otherwise(F.lit("fit")).alias("role")).checkpoint()
    _, sel, design = design_rows(samples, roles, cfg)
    cc, fit = ["repeat", "fold"], F.col("role") == "fit"
    fits = spark.createDataFrame([(0, 0, -1, "ET", json.dumps(params))], "fit int, repeat int, fold int, program string, params string")
    models = CE.fit_cells(CE.block_table(design.filter(fit), cc, block_rows=cfg.block_rows).checkpoint(), fits, cc, MD.PROGRAMS, cfg.seed, cfg.whole_bytes).checkpoint()
    held = CE.block_table(design.filter(~fit), [*cc, "role"], block_rows=cfg.block_rows)
    phi = EX.contributions(held, fits, models, cc).checkpoint()
    design.unpersist()
    support = sel.groupBy(*cc).agg(F.array_sort(F.collect_list(F.struct("step", "feature_idx"))).alias("_s")).select(*cc, F.col("_s.feature_idx").alias("sel"))
    importance = EX.mean_contributions(phi, cc, support)
    return {"contributions": phi, "support": support, "importance": importance, "top": EX.top_features(importance, cc, n)}


def _manifest(run: Run, metrics: DataFrame) -> DataFrame:
    """The run's sizes, its best run and, over at least three models and two
    repeats, the Friedman test of macro-F1."""
    cfg = run.cfg
    n_models = len(cfg.models) + bool(cfg.ensemble_members)
    sizes = run.samples.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(cfg.group).alias("n_groups"), F.sum(F.col("label").cast("long")).alias("n_positive"))
    order = [m for m in MODEL_ORDER if m in cfg.models or m == "Ensemble"]
    best = RP.best_run(metrics, "macro_f1", order).select(F.col("model").alias("best_model"), F.col("repeat").alias("best_repeat"), F.col("macro_f1").alias("best_macro_f1"))
    tested = n_models >= 3 and cfg.n_repeats >= 2
    test = ST.friedman(metrics) if tested else run.spark.range(1).select(F.lit(None).cast("double").alias("statistic"), F.lit(None).cast("double").alias("p_value"))
    facts = run.spark.range(1).select(F.lit(cfg.seed).alias("seed"), F.lit(cfg.n_repeats).alias("n_repeats"), F.lit(cfg.n_trials).alias("n_trials"),
                                      F.lit(cfg.n_folds).alias("n_folds"), F.lit(",".join(cfg.models)).alias("models"), F.lit(run.out).alias("run_dir"))
    return facts.crossJoin(sizes).crossJoin(best).crossJoin(test.select(F.col("statistic").alias("friedman_statistic"), F.col("p_value").alias("friedman_p")))  # one row each
