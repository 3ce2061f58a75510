"""Model estimators over the grouped sample table.

Built-in Spark ML estimators do the distributed fitting (logistic regression,
random forest, gradient-boosted trees, linear SVM); this module adds the
evaluation-protocol pieces around them: balanced class weights, the seeded
hyper-parameter trial table, the model registry, random Fourier features for
the RBF-kernel SVM, and probability/score extraction.
"""
from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.functions.exprs import DEFAULT_SEED, attach_scalar, seeded_uniform
from tessera.operators import cells, linear, trees
from tessera.session import ensure_checkpoint_dir

# Hyper-parameter search space per model (kind, low, high, step/choices).
MRMR_K_CHOICES = (20, 50, 100)
SEARCH_SPACE: dict[str, dict[str, tuple]] = {
    "LR": {"C": ("log", 1e-3, 1e2), "penalty": ("cat", ("l1", "l2"))},
    "SVM": {"C": ("log", 1e-2, 1e2), "gamma": ("log", 1e-4, 1e0)},
    "RF": {"n_estimators": ("int", 100, 500, 50), "max_depth": ("int", 3, 20, 1),
           "min_samples_leaf": ("int", 1, 10, 1), "max_features": ("cat", ("sqrt", "log2"))},
    "ET": {"n_estimators": ("int", 100, 500, 50), "max_depth": ("int", 3, 20, 1),
           "min_samples_leaf": ("int", 1, 10, 1), "max_features": ("cat", ("sqrt", "log2"))},
    "GB": {"n_estimators": ("int", 100, 500, 50), "learning_rate": ("log", 1e-3, 3e-1),
           "max_depth": ("int", 2, 8, 1), "subsample": ("float", 0.5, 1.0)},
    "KNN": {"n_neighbors": ("int", 3, 25, 1), "weights": ("cat", ("uniform", "distance")),
            "metric": ("cat", ("euclidean", "manhattan"))},
}
RFF_DIM = 256
MODELS = ("LR", "SVM", "RF", "ET", "GB", "KNN")
#: fit programs (M1 to M5) and what gives a fitted one's score; k-NN keeps rows and is no program
PROGRAMS = {"LR": linear.logistic, "SVM": linear.svm, "RF": trees.random_forest, "ET": trees.extra_trees, "GB": trees.boosting}
SCORERS = {"LR": linear.logistic_score, "SVM": linear.svm_margin, "RF": trees.forest_score, "ET": trees.forest_score, "GB": trees.boosted_score}
MAX_ITER = 10_000


def class_weights(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                  out: str = "weight") -> DataFrame:
    """M8: balanced class weight ``n / (2 · n_class)`` per row, per cell.

    Counts are a partial aggregate per (cell, label) — two rows per cell —
    joined back (broadcast by AQE), so no cell is gathered into one task."""
    by = list(by)
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_nc"))
    t = c.groupBy(*by).agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = (c.join(t, by) if by else attach_scalar(c, t)).select(
        *by, label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(w, [*by, label])


def trial_table(spark: SparkSession, models: Sequence[str], n_trials: int,
                seed: int = DEFAULT_SEED) -> DataFrame:
    """M9: seeded random trials ``(model, trial, param, value, choice)``.

    Each parameter draws u ~ U[0,1) from md5(seed:model:trial:param):
    log-uniform floats, uniform floats, stepped ints and categoricals; every
    trial also draws ``mrmr_k``.  Generated with ``range`` + ``explode``."""
    rows = []
    for m in models:
        space = {"mrmr_k": ("cat", tuple(str(k) for k in MRMR_K_CHOICES)), **SEARCH_SPACE[m]}
        for name, spec in space.items():
            rows.append((m, name, spec[0], float(spec[1]) if spec[0] != "cat" else 0.0,
                         float(spec[2]) if spec[0] != "cat" else 0.0,
                         float(spec[3]) if spec[0] == "int" else 1.0,
                         list(spec[1]) if spec[0] == "cat" else []))
    space_df = spark.createDataFrame(rows, "model string, param string, kind string, lo double, hi double, "
                                           "step double, choices array<string>")
    u = seeded_uniform(seed, "model", "trial", "param")
    t = space_df.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1)))).withColumn("_u", u)
    lo, hi, step = F.col("lo"), F.col("hi"), F.col("step")
    value = (F.when(F.col("kind") == "log", F.exp(F.log(lo) + F.col("_u") * (F.log(hi) - F.log(lo))))
              .when(F.col("kind") == "float", lo + F.col("_u") * (hi - lo))
              .when(F.col("kind") == "int", lo + F.floor(F.col("_u") * (F.floor((hi - lo) / step) + 1)) * step))
    choice = F.when(F.col("kind") == "cat",
                    F.element_at("choices", (F.floor(F.col("_u") * F.size("choices")) + 1).cast("int")))
    return t.select("model", "trial", "param", value.alias("value"), choice.alias("choice"))


def trial_params(trials: DataFrame) -> dict[tuple[str, int], dict[str, Any]]:
    """The (models × trials)-sized parameter table as dicts for the fit loop."""
    out: dict[tuple[str, int], dict[str, Any]] = {}
    for r in trials.collect():
        d = out.setdefault((r.model, r.trial), {})
        if r.choice is not None:
            d[r.param] = int(r.choice) if r.param == "mrmr_k" else r.choice
        else:
            v = r.value
            d[r.param] = int(round(v)) if SEARCH_SPACE[r.model][r.param][0] == "int" else float(v)
    return out


def rff_weights(dim_in: int, gamma: float, dim_out: int = RFF_DIM, seed: int = DEFAULT_SEED):
    """Random Fourier features for exp(-γ‖x−y‖²): W ~ N(0, 2γ), b ~ U[0, 2π)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), size=(dim_in, dim_out)), rng.uniform(0, 2 * math.pi, dim_out)


def random_fourier(df: DataFrame, col: str, gamma: float, dim_out: int = RFF_DIM,
                   seed: int = DEFAULT_SEED, out: str = "rff") -> DataFrame:
    """M2 feature map ``sqrt(2/D)·cos(xW + b)`` as an Arrow-batched UDF
    (one matrix product per batch; W and b are small and captured once)."""
    first = df.select(F.size(col).alias("d")).first()
    dim_in = int(first.d) if first else 0
    W, b = rff_weights(dim_in, gamma, dim_out, seed)
    scale = math.sqrt(2.0 / dim_out)

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(xs: pd.Series) -> pd.Series:
        if len(xs) == 0:
            return pd.Series([], dtype=object)
        X = np.vstack(xs.to_numpy()).astype(np.float64)
        Z = scale * np.cos(X @ W + b)
        return pd.Series(list(Z))

    return df.withColumn(out, rff(F.col(col)))


def build_estimator(model: str, params: Mapping[str, Any], n_weight: float, features: str = "fv",
                    label: str = "label", weight: str = "weight", seed: int = DEFAULT_SEED):
    """M7: registry name → unfitted Spark ML estimator (unknown name → error).

    ``n_weight`` is the total class weight of the fit rows: penalised
    objectives are rescaled so C·Σw·loss + penalty matches the library's.
    ``params["max_iter"]`` bounds the steps of LR and SVM; ``converged`` tells
    whether a fit ended before."""
    max_iter = int(params.get("max_iter", MAX_ITER))
    if model == "LR":
        return LogisticRegression(featuresCol=features, labelCol=label, weightCol=weight,
                                  regParam=1.0 / (params["C"] * n_weight),
                                  elasticNetParam=1.0 if params["penalty"] == "l1" else 0.0,
                                  standardization=False, maxIter=max_iter, tol=1e-6)
    if model == "SVM":
        return LinearSVC(featuresCol=features, labelCol=label, weightCol=weight,
                         regParam=1.0 / (params["C"] * n_weight), standardization=False, maxIter=max_iter)
    if model == "RF":
        return RandomForestClassifier(featuresCol=features, labelCol=label, weightCol=weight,
                                      numTrees=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                                      minInstancesPerNode=int(params["min_samples_leaf"]),
                                      featureSubsetStrategy=params["max_features"], seed=seed)
    if model == "GB":
        return GBTClassifier(featuresCol=features, labelCol=label, maxIter=int(params["n_estimators"]),
                             stepSize=float(params["learning_rate"]), maxDepth=int(params["max_depth"]),
                             subsamplingRate=float(params["subsample"]), seed=seed)
    if model in SEARCH_SPACE:
        raise NotImplementedError(f"model {model} has no Spark ML estimator; see PROGRAMS")
    raise ValueError(f"Unknown model: {model}")


def converged(model: str, fitted) -> bool | None:
    """Whether an iterative fit (LR, SVM) ended by its own rule before its bound
    on steps; None for models whose number of steps is a parameter."""
    if model not in ("LR", "SVM"):
        return None
    summary = fitted.summary if model == "LR" else fitted.summary()
    return summary.totalIterations < fitted.getMaxIter()


KNN_TRAIN_ROWS = 20_000


def knn_scores(train: DataFrame, queries: DataFrame, k: int, weights: str = "uniform", metric: str = "euclidean",
               features: str = "xs", label: str = "label", key: str = "row_id", max_train_rows: int = KNN_TRAIN_ROWS,
               exclude_self: bool = False, out: str = "score") -> DataFrame:
    """M6: ``queries`` with the k-NN share of positive labels as ``out``.

    At most ``max_train_rows`` training rows are used (beyond that, the ones
    with the least md5 of their key), so the matrix that tasks receive is
    bounded by rows × features.  Each Arrow batch compares its rows with the
    matrix in blocks and keeps the k nearest; no pair leaves the task.  Ties in
    distance go to the smaller key; ``distance`` weights are 1/d, and rows at
    distance 0, if any, share the vote.  ``exclude_self`` skips the row with the
    query's own key.  Features must not be missing.
    """
    if weights not in ("uniform", "distance") or metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown k-NN option: {weights}, {metric}")
    rows = train.select(F.col(key).alias("k"), F.col(label).alias("y"), F.col(features).alias("x"))
    rows = rows.orderBy(F.md5(F.col("k").cast("string"))).limit(max_train_rows).toPandas().sort_values("k")
    x = np.vstack(rows["x"].to_numpy()).astype(float) if len(rows) else np.zeros((0, 0))
    sent = queries.sparkSession.sparkContext.broadcast((rows["k"].to_numpy(), rows["y"].to_numpy(float), x))

    @pandas_udf(T.DoubleType())
    def vote(own: pd.Series, points: pd.Series) -> pd.Series:
        keys, y, x = sent.value
        result = np.full(len(points), np.nan)
        step = max(1, 2_000_000 // max(1, x.size))
        for lo in range(0, len(points) if len(y) else 0, step):
            q = np.vstack(points.iloc[lo:lo + step].to_numpy()).astype(float)
            apart = q[:, None, :] - x[None]
            d = np.sqrt((apart ** 2).sum(-1)) if metric == "euclidean" else np.abs(apart).sum(-1)
            if exclude_self:
                d[own.iloc[lo:lo + step].to_numpy()[:, None] == keys[None]] = np.inf
            near = np.argsort(d, axis=1, kind="stable")[:, :k]
            dist = np.take_along_axis(d, near, 1)
            w = np.isfinite(dist).astype(float)
            if weights == "distance":
                zero = (dist == 0).any(1, keepdims=True)
                w = np.where(zero, dist == 0, w / np.where(dist == 0, 1, dist))
            result[lo:lo + len(q)] = (w * y[near]).sum(1) / w.sum(1)
        return pd.Series(result)

    return queries.withColumn(out, vote(F.col(key), F.col(features)))


KNN_BLOCK_ROWS = 5_000
KNN_PAIRS = 2_000_000  # distances that a task holds at once


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row of ``a`` to the row of ``b`` beside it."""
    apart = a - b
    return np.sqrt((apart ** 2).sum(-1)) if metric == "euclidean" else np.abs(apart).sum(-1)


def _may_be_near(q: np.ndarray, x: np.ndarray, other: np.ndarray, k: int, metric: str, bound: np.ndarray | None = None) -> np.ndarray:
    """Mask (queries x rows) that holds the ``k`` nearest rows of every query and
    all that tie with them, among the pairs of ``other``.

    Distances are found quickly first (a matrix product; absolute differences in
    single precision), and a bound on their rounding errors is added to the k-th
    least.  ``bound`` has the distance up to which rows matter to each query; where
    it is known for all, it stands for the k-th least.  Numbers so large (or none)
    that this may overflow leave all pairs in."""
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    known = bound is not None and np.isfinite(bound).all()
    if (k >= len(x) and not known) or not largest < 1e30:
        return other
    if metric == "euclidean":
        sizes = (q ** 2).sum(1)[:, None], (x ** 2).sum(1)[None]
        near = q @ x.T
        near *= -2
        near += sizes[0]
        near += sizes[1]
        error = 8 * (q.shape[1] + 8) * np.finfo(np.float64).eps * (sizes[0][:, 0] + sizes[1].max()) + 1e-300
    else:
        near, work = np.zeros((len(q), len(x)), np.float32), np.empty((len(q), len(x)), np.float32)
        for a, b in zip(q.T.astype(np.float32), np.ascontiguousarray(x.T, dtype=np.float32)):
            np.subtract(a[:, None], b[None], out=work)
            np.abs(work, out=work)
            near += work
        error = 4 * (q.shape[1] + 8) * np.finfo(np.float32).eps * (np.abs(q).sum(1) + np.abs(x).sum(1).max()) + 1e-36
    if known:
        with np.errstate(over="ignore"):
            limit = (bound ** 2 if metric == "euclidean" else bound) * (1 + 1e-9) + error
        return other & (near <= limit[:, None])
    near[~other] = np.inf
    least = np.partition(near, k - 1, axis=1)[:, k - 1].astype(float)
    return other & (near <= (least + error)[:, None])


def _candidates(q: np.ndarray, own: np.ndarray, x: np.ndarray, keys: np.ndarray, k: int, metric: str, exclude_self: bool, bound: np.ndarray | None = None):
    """``row, place, d`` by pieces of the queries: pairs that hold the ``k`` nearest
    rows of each query (within ``bound``, if given), by row, distance and place.
    Distances that are not finite are left out."""
    # a piece of few queries stays in the cache while it is gone through once for each feature
    step = max(1, min(KNN_PAIRS, 16 * 8192 if metric == "manhattan" else KNN_PAIRS) // max(1, len(x)))
    for lo in range(0, len(q), step):
        part, limit = q[lo:lo + step], None if bound is None else bound[lo:lo + step]
        other = own[lo:lo + step][:, None] != keys[None] if exclude_self else np.ones((len(part), len(x)), bool)
        row, place = np.nonzero(_may_be_near(part, x, other, k, metric, limit))
        d, pairs = np.empty(len(row)), max(1, KNN_PAIRS // max(1, x.shape[1]))
        for i in range(0, len(row), pairs):
            d[i:i + pairs] = _distances(part[row[i:i + pairs]], x[place[i:i + pairs]], metric)
        use = np.isfinite(d) if limit is None else np.isfinite(d) & (d <= limit[row])
        row, place, d = row[use], place[use], d[use]
        order = np.lexsort((place, d, row))
        yield lo, len(part), row[order], place[order], d[order]


def _nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, keys: np.ndarray, k: int, metric: str, exclude_self: bool):
    """``(distances, places in x)`` of the ``k`` nearest rows of each query; of
    equal distances the first places.  Distances that are not finite are left out."""
    for _, n, row, place, d in _candidates(q, own, x, keys, k, metric, exclude_self):
        first = np.searchsorted(row, np.arange(n + 1))
        for a, b in zip(first, np.minimum(first[:-1] + k, first[1:])):
            yield d[a:b], place[a:b]


def _first_of_each(row: np.ndarray, k: int, *order: np.ndarray) -> np.ndarray:
    """Places of the first ``k`` entries of each row in the order of ``order``, by row."""
    by = np.lexsort((*order[::-1], row))
    ranked = row[by]
    first = np.searchsorted(ranked, ranked)  # where each entry's row begins
    return by[np.arange(len(by)) - first < k]


def search_blocks(q: np.ndarray, own: np.ndarray, blocks, k: int, metric: str, exclude_self: bool = False):
    """The ``k`` nearest rows of each query over all ``blocks`` (``x, keys, order,
    told``: an array of features, keys, what decides between equal distances, and
    an Arrow table of what to tell of a row), which go by one at a time.

    Returns ``row, d, told``: the entries by query, distance and order.  What is held
    besides a block are k entries for each query: after the first blocks only rows
    nearer than the k-th so far are looked at."""
    row, d, order, told = np.zeros(0, np.int64), np.zeros(0), None, None
    for x, keys, tie, table in blocks:
        if not len(x):
            continue
        bound, full = np.full(len(q), np.inf), np.bincount(row, minlength=len(q)) >= k
        np.maximum.at(farthest := np.zeros(len(q)), row, d)
        bound[full] = farthest[full]
        found = [(lo + r, place, dist) for lo, _, r, place, dist in _candidates(q, own, x, keys, k, metric, exclude_self, bound)]
        new_row, place, new_d = (np.concatenate(v) for v in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        mine = _first_of_each(new_row, k, new_d, tie[place], place)
        new_row, place, new_d = new_row[mine], place[mine], new_d[mine]
        row, d = np.concatenate([row, new_row]), np.concatenate([d, new_d])
        order = tie[place] if order is None else np.concatenate([order, tie[place]])
        new_told = table.take(pa.array(place))
        told = new_told if told is None else pa.concat_tables([told, new_told])
        keep = _first_of_each(row, k, d, order)  # a stable order: of the same, those of earlier blocks first
        row, d, order, told = row[keep], d[keep], order[keep], told.take(pa.array(keep)).combine_chunks()
    return row, d, told


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of numbers as an array; all must have as many."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        raise ValueError("k-NN needs the features of every row")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    widths = np.unique(np.diff(column.offsets.to_numpy())) if len(column) else np.zeros(0)
    if len(widths) > 1:
        raise ValueError("k-NN needs as many features in every row")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def training_files(train: DataFrame, features: str = "xs", label: str = "label", key: str = "row_id") -> list[str]:
    """Files of ``k, y, x`` (key, label, features) in the shared checkpoint folder, by
    key (and label) over all files, for the tasks of ``nearest_rows`` to read."""
    spark = train.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/knn-{uuid.uuid4().hex}"
    rows = train.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y"), F.col(features).alias("x"))
    rows.orderBy("k", "y").write.option("compression", "zstd").parquet(path)
    return sorted(spark.read.schema(rows.schema).parquet(path).inputFiles())  # named by their order


def spread(queries: DataFrame, block_rows: int = KNN_BLOCK_ROWS) -> DataFrame:
    """``queries`` dealt over all tasks, about ``block_rows`` to a task at most."""
    n = queries.count()
    return queries.repartition(max(1, math.ceil(n / block_rows), min(math.ceil(n / 128), 2 * queries.sparkSession.sparkContext.defaultParallelism)))


def nearest_rows(train: DataFrame, queries: DataFrame, k: int, metric: str = "euclidean", features: str = "xs", label: str = "label",
                 key: str = "row_id", block_rows: int = KNN_BLOCK_ROWS, exclude_self: bool = False, out: str = "n", files: list[str] | None = None) -> DataFrame:
    """``queries`` with the ``k`` nearest training rows of each as ``out``: structs
    ``d, ks, ys`` (distance, key, label) in the order of distance and key.

    The training rows are written once to the shared checkpoint folder, and every
    task reads them from there in pieces of ``block_rows`` for its own queries, which
    keep k entries each.  All pairs of rows are compared (that is the job), but
    neither rows nor lists are copied for it: what is written grows with the rows.
    A caller that searches several times hands in the rows' files
    (``training_files``) and queries that it has spread."""
    if metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown k-NN option: {metric}")
    if files is None:
        files, queries = training_files(train, features, label, key), spread(queries, block_rows)
    kind = T.ArrayType(T.StructType([T.StructField("d", T.DoubleType()), T.StructField("ks", train.schema[key].dataType), T.StructField("ys", T.DoubleType())]))
    schema = T.StructType([*queries.schema.fields, T.StructField(out, kind)])
    arrow = to_arrow_schema(schema)
    entry = arrow.field(out).type.value_type

    def pieces():
        done = 0
        for table in cells.file_batches(files, block_rows):
            yield _matrix(table.column("x")), table.column("k").to_numpy(), np.arange(done, done + len(table)), table.select(["k", "y"])
            done += len(table)

    def run(batches):
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            row, d, told = search_blocks(_matrix(batch.column(batch.schema.get_field_index(features))), own, pieces(), k, metric, exclude_self)
            if told is None:
                lists = pa.array([[]] * len(batch), arrow.field(out).type)
            else:
                ks, ys = (told.column(c).combine_chunks() for c in ("k", "y"))
                values = pa.StructArray.from_arrays([pa.array(d), ks.cast(entry.field("ks").type), ys], fields=list(entry))
                ends = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), values).cast(arrow.field(out).type)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, arrow)] + [lists], schema=arrow)

    return queries.mapInArrow(run, schema)


def knn_scores_exact(train: DataFrame, queries: DataFrame, k: int, weights: str = "uniform", metric: str = "euclidean",
                     features: str = "xs", label: str = "label", key: str = "row_id", block_rows: int = KNN_BLOCK_ROWS,
                     exclude_self: bool = False, out: str = "score", near: str | None = None) -> DataFrame:
    """M6 against every training row: ``knn_scores`` without its bound.

    The neighbours are those of ``nearest_rows``; a caller that votes several times
    over the same rows, k and metric names the column of ``queries`` that holds
    them as ``near``.  Rules for ties, weights and ``exclude_self`` are those of
    ``knn_scores``; a query without any neighbour gets NaN."""
    if weights not in ("uniform", "distance") or metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown k-NN option: {weights}, {metric}")
    n = near or "_near"
    found = queries if near else nearest_rows(train, queries, k, metric, features, label, key, block_rows, exclude_self, n)
    zero = F.filter(n, lambda v: v["d"] == 0)
    total = lambda a, f: F.aggregate(F.transform(a, f), F.lit(0.0), lambda s, v: s + v)
    mean = lambda a: total(a, lambda v: v["ys"]) / F.size(a)
    inverse = total(n, lambda v: v["ys"] / v["d"]) / total(n, lambda v: F.lit(1.0) / v["d"])
    vote = mean(n) if weights == "uniform" else F.when(F.size(zero) > 0, mean(zero)).otherwise(inverse)
    score = F.coalesce(F.when(F.size(n) > 0, vote), F.lit(float("nan")))
    return found.withColumn(out, score).drop(*([] if near else [n]))


def knn_votes(row: np.ndarray, d: np.ndarray, y: np.ndarray, queries: int, weights: str) -> np.ndarray:
    """The vote of each query's neighbours (entries of ``search_blocks``)."""
    count = np.bincount(row, minlength=queries)
    dist, votes = np.full((queries, count.max(initial=0)), np.inf), np.zeros((queries, count.max(initial=0)))
    column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    dist[row, column], votes[row, column] = d, y
    w = np.isfinite(dist).astype(float)
    if weights == "distance":
        zero = (dist == 0).any(1, keepdims=True)
        w = np.where(zero, dist == 0, w / np.where(dist == 0, 1, dist))
    with np.errstate(divide="ignore", invalid="ignore"):
        return (w * votes).sum(1) / w.sum(1)  # summed as in ``knn_scores``


def knn_cells(fit_blocks: DataFrame, out_blocks: DataFrame, fits: DataFrame, cell: Sequence[str]) -> DataFrame:
    """M6 for many cells: the columns of ``cells.score_cells`` for each fit of
    program KNN, whose ``params`` hold ``n_neighbors``, ``weights``, ``metric`` and
    ``mrmr_k``.  Every training row of the cell votes: a task reads the cell's blocks
    from the files of ``fit_blocks``, one at a time, for its own
    block of queries."""
    files, cell = cells.block_files(fit_blocks), list(cell)

    def pieces(row, width):
        for own in cells.blocks_of(files, {c: row[c] for c in cell}):
            b = cells._block(own, (), width)
            yield b.x, b.key, b.key, pa.table({"y": b.y})

    def score(row, params, b):
        found, d, told = search_blocks(b.x, b.key, pieces(row, b.x.shape[1]), int(params["n_neighbors"]), params["metric"])
        y = np.zeros(0) if told is None else told.column("y").to_numpy()
        votes = knn_votes(found, d, y, len(b.x), params["weights"])
        return pa.array(votes, mask=np.isnan(votes)), None  # no vote, no score

    return cells.scored(out_blocks, out_blocks.join(F.broadcast(fits.select("fit", *cell, "program", "params")), cell), score)  # fits: one row for each fit


def score_column(model: str) -> F.Column:
    """Positive-class score of a fitted model's output: P(y=1) for
    probabilistic models, the margin for the linear SVM (calibrated later)."""
    if model == "SVM":
        return vector_to_array("rawPrediction")[1]
    return vector_to_array("probability")[1]


def to_vector(df: DataFrame, arr: str, out: str = "fv") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr)))
