"""Fold-safe feature preparation, fitted per cell on that cell's fit rows:
median imputation → population-variance filter → ordered correlation filter
→ robust scaling; plus the transform that applies a fitted cell to any rows.

Layout: samples carry ``features array<double>`` (NULL = missing); per-cell
statistics are computed on the long view ``(cell…, row_id, feature_idx, value)``
with one aggregation per statistic family; the fitted state is a small
parameter table ``(cell…, feature_idx, …)`` (cells × features rows).
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import CORRELATION_THRESHOLD, VARIANCE_THRESHOLD
from tessera.operators.packed import by_key, interpolated

EPS_SCALE = 10 * np.finfo(np.float64).eps


def fit_rows(samples: DataFrame, cells: DataFrame, cell_cols: Sequence[str],
             group: str = "patient_id") -> DataFrame:
    """Rows of every cell's fit set: ``cells`` lists ``(cell…, group)``."""
    return samples.join(cells.select(*cell_cols, group), group)


def to_long(rows: DataFrame, cell_cols: Sequence[str], features: str = "features") -> DataFrame:
    """Long view ``(cell…, row_id, feature_idx, value)`` (feature_idx 1-based)."""
    return (rows.select(*cell_cols, "row_id", F.posexplode(features).alias("_p", "value"))
            .select(*cell_cols, "row_id", (F.col("_p") + 1).alias("feature_idx"), "value"))


def medians(long: DataFrame, cell_cols: Sequence[str]) -> DataFrame:
    """F1 fit: exact interpolated median of the non-missing values; a feature
    missing everywhere in the cell gets NULL (and is dropped)."""
    def median(value, present):
        own = np.sort(value[present > 0])
        return {"median": interpolated(own, 0.5), "n_present": len(own)}

    told = long.select(*cell_cols, "feature_idx", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"),
                       F.col("value").isNotNull().cast("int").alias("present"))
    return by_key(told, [*cell_cols, "feature_idx"], {"value": "double", "present": "int"}, median, "median double, n_present long")


def imputed_stats(long: DataFrame, med: DataFrame, cell_cols: Sequence[str]) -> DataFrame:
    """F2 + F4 fit on imputed values: population variance, q25, q75."""
    def stats(x):
        x = np.sort(x)
        with np.errstate(invalid="ignore"):
            variance = float(np.mean((x - x.mean()) ** 2))
        return {"var_pop": variance, "q1": interpolated(x, 0.25), "q3": interpolated(x, 0.75), "n": len(x)}

    # one row for each cell and feature is sent to the tasks
    j = long.join(F.broadcast(med.filter(F.col("median").isNotNull())), [*cell_cols, "feature_idx"])
    told = j.select(*cell_cols, "feature_idx", "median", F.coalesce(F.col("value"), F.col("median")).cast("double").alias("x"))
    return by_key(told, [*cell_cols, "feature_idx", "median"], {"x": "double"}, stats, "var_pop double, q1 double, q3 double, n long")


def variance_filter(stats: DataFrame, threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """keep iff population variance > threshold."""
    return stats.withColumn("keep_var", F.col("var_pop") > threshold)


def cell_arrays(params: DataFrame, cell_cols: Sequence[str], value_cols: Sequence[str],
                idx: str = "feature_idx") -> DataFrame:
    """Per cell, parameter columns as arrays ordered by feature index
    (``_idx`` + one array per value column).  Size: features per cell."""
    s = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), *[F.col(c) for c in value_cols])))
    g = params.groupBy(*cell_cols).agg(s.alias("_s"))
    return g.select(*cell_cols, F.col("_s.i").alias("_idx"), *[F.col(f"_s.{c}").alias(c) for c in value_cols])


def _gram_schema(cell_fields: list[T.StructField]) -> T.StructType:
    return T.StructType(cell_fields + [
        T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("si", T.DoubleType()),
        T.StructField("sj", T.DoubleType()), T.StructField("sij", T.DoubleType())])


def gram(rows: DataFrame, cell_cols: Sequence[str], params: DataFrame, features: str = "features") -> DataFrame:
    """Upper-triangle sufficient statistics of the candidate features per cell.

    Each row is imputed with its cell's medians and shifted by them (Pearson r
    is shift-invariant; the shift keeps the sums well conditioned).  Every
    task reduces its rows to one partial Gram per cell with numpy and emits it
    as long rows; Spark sums the partials per (cell, i, j).  ``params`` holds
    ``(cell…, feature_idx, median)`` for the candidate features only."""
    cell_cols = list(cell_cols)
    arr = cell_arrays(params, cell_cols, ["median"])
    data = rows.join(F.broadcast(arr), cell_cols).select(  # one row for each cell
        *cell_cols, F.col("_idx"),
        F.transform("_idx", lambda i, p: F.coalesce(F.col(features)[i - 1], F.col("median")[p])
                    - F.col("median")[p]).alias("x"))
    cell_fields = [f for f in data.schema.fields if f.name in cell_cols]
    schema = _gram_schema(cell_fields)

    def partial(batches):
        sums = {}  # cell -> features, rows, sums, products: d + d*d numbers a cell, whatever the number of rows
        for pdf in batches:
            for key, g in pdf.groupby(cell_cols, sort=False):
                key = key if isinstance(key, tuple) else (key,)
                X = np.vstack(g["x"].to_numpy()).astype(np.float64)
                idx, n, s, G = sums.get(key, (np.asarray(g["_idx"].iloc[0], dtype=np.int32), 0, 0.0, 0.0))
                sums[key] = (idx, n + len(X), s + X.sum(axis=0), G + X.T @ X)
        for key, (idx, n, s, G) in sums.items():
            iu, ju = np.triu_indices(len(idx))
            out = {c: [k] * len(iu) for c, k in zip(cell_cols, key)}
            out.update(i=idx[iu], j=idx[ju], n=np.full(len(iu), n, dtype=np.int64),
                       si=s[iu], sj=s[ju], sij=G[iu, ju])
            yield pd.DataFrame(out)

    parts = data.mapInPandas(partial, schema)
    return parts.groupBy(*cell_cols, "i", "j").agg(
        F.sum("n").alias("n"), F.sum("si").alias("si"), F.sum("sj").alias("sj"), F.sum("sij").alias("sij"))


def correlations(g: DataFrame, cell_cols: Sequence[str]) -> DataFrame:
    """Pearson r for i < j from the Gram table; NaN (a constant) → 0."""
    cell_cols = list(cell_cols)
    diag = g.filter(F.col("i") == F.col("j")).select(
        *cell_cols, F.col("i").alias("k"), (F.col("n") * F.col("sij") - F.col("si") * F.col("si")).alias("v"))
    off = g.filter(F.col("i") < F.col("j"))
    di = diag.select(*cell_cols, F.col("k").alias("i"), F.col("v").alias("vi"))
    dj = diag.select(*cell_cols, F.col("k").alias("j"), F.col("v").alias("vj"))
    c = off.join(di, [*cell_cols, "i"]).join(dj, [*cell_cols, "j"])
    num = F.col("n") * F.col("sij") - F.col("si") * F.col("sj")
    den = F.sqrt(F.col("vi") * F.col("vj"))
    r = F.when((F.col("vi") <= 0) | (F.col("vj") <= 0), F.lit(0.0)).otherwise(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), num / den)))
    return c.select(*cell_cols, "i", "j", r.alias("r"))


def corr_edges(corr: DataFrame, threshold: float = CORRELATION_THRESHOLD) -> DataFrame:
    """Edges i < j with |r| > threshold."""
    return corr.filter(F.abs("r") > threshold).select(*[c for c in corr.columns if c != "r"], "r")


def ordered_independent_set(nodes: DataFrame, edges: DataFrame, cell_cols: Sequence[str]) -> DataFrame:
    """F3 selection: scan features in index order and keep one unless a kept
    lower-indexed feature is its neighbour (a dropped feature drops nobody).

    Only features that have an edge need the scan; every other candidate is
    kept by an anti-join.  The scan runs per cell over that cell's edge list
    (bounded by feature pairs, independent of row count) in one grouped
    pandas task per cell.  Returns ``(cell…, feature_idx)`` of kept nodes."""
    cell_cols = list(cell_cols)
    e = edges.select(*cell_cols, F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"))
    out_schema = T.StructType([f for f in e.schema.fields if f.name in cell_cols]
                              + [T.StructField("feature_idx", T.IntegerType())])

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        dropped: set[int] = set()
        nbrs: dict[int, list[int]] = {}
        for i, j in zip(pdf["i"].to_numpy(), pdf["j"].to_numpy()):
            nbrs.setdefault(int(i), []).append(int(j))
        for i in sorted(nbrs):
            if i in dropped:
                continue
            dropped.update(nbrs[i])
        key = {c: pdf[c].iloc[0] for c in cell_cols}
        return pd.DataFrame({**{c: [v] * len(dropped) for c, v in key.items()},
                             "feature_idx": sorted(dropped)})

    dropped = e.groupBy(*cell_cols).applyInPandas(scan, out_schema)
    return nodes.select(*cell_cols, "feature_idx").join(dropped, [*cell_cols, "feature_idx"], "left_anti")


def robust_scale_params(stats: DataFrame) -> DataFrame:
    """center = median, scale = q3 − q1 (a zero range divides by 1)."""
    rng = F.col("q3") - F.col("q1")
    return stats.withColumn("center", F.col("median")).withColumn(
        "scale", F.when(rng < EPS_SCALE, F.lit(1.0)).otherwise(rng))


class FeaturePrep:
    """impute → variance → correlation → robust scale, fitted for every
    cell in one batched job.  ``fit`` returns a :class:`FeaturePrepModel`."""

    def __init__(self, cell_cols: Sequence[str] = ("repeat",), group: str = "patient_id",
                 var_threshold: float = VARIANCE_THRESHOLD, corr_threshold: float = CORRELATION_THRESHOLD):
        self.cell_cols = list(cell_cols)
        self.group = group
        self.var_threshold = var_threshold
        self.corr_threshold = corr_threshold

    def fit(self, samples: DataFrame, cells: DataFrame) -> "FeaturePrepModel":
        cc = self.cell_cols
        rows = fit_rows(samples, cells, cc, self.group)
        long = to_long(rows, cc)
        med = medians(long, cc)
        # fitted state is materialised (reliable checkpoint in the session's
        # checkpoint dir): it is small (cells × features) and reused many times
        stats = variance_filter(imputed_stats(long, med, cc), self.var_threshold).checkpoint()
        cand = stats.filter("keep_var")
        g = gram(rows, cc, cand.select(*cc, "feature_idx", "median"))
        corr = correlations(g, cc).checkpoint()
        edges = corr_edges(corr, self.corr_threshold)
        kept = ordered_independent_set(cand.select(*cc, "feature_idx"), edges, cc)
        params = robust_scale_params(stats.join(kept.withColumn("keep", F.lit(True)),
                                                [*cc, "feature_idx"], "left")
                                     .withColumn("keep", F.coalesce("keep", F.lit(False)))).checkpoint()
        return FeaturePrepModel(cc, params, stats.select(*cc, "feature_idx", "median"), corr, edges)


class FeaturePrepModel:
    def __init__(self, cell_cols, params, med, corr, edges):
        self.cell_cols, self.params, self.medians, self.corr, self.edges = cell_cols, params, med, corr, edges

    def support(self) -> DataFrame:
        """Surviving features per cell, in order, with positions."""
        w = Window.partitionBy(*self.cell_cols).orderBy("feature_idx")
        return (self.params.filter("keep").select(*self.cell_cols, "feature_idx")
                .withColumn("position", F.row_number().over(w) - 1))

    def transform(self, rows: DataFrame, features: str = "features", out: str = "x") -> DataFrame:
        """Impute with the cell's medians, keep the support in order, scale.
        ``rows`` must carry the cell columns (rows are replicated per cell)."""
        cc = self.cell_cols
        kept = cell_arrays(self.params.filter("keep"), cc, ["center", "scale"])
        j = rows.join(F.broadcast(kept), cc)  # one row for each cell
        x = F.transform("_idx", lambda i, p: (F.coalesce(F.col(features)[i - 1], F.col("center")[p])
                                              - F.col("center")[p]) / F.col("scale")[p])
        return j.withColumn(out, x).withColumnRenamed("_idx", "support").drop("center", "scale")
