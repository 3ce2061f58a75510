"""Feature relevance and selection per cell: k-NN mutual information with a
binary label, binned mutual information, greedy MRMR and selection stability.

Inputs are long views ``(cell…, feature_idx, row_id, label, x)`` (imputed, no
NULLs).  Every (cell, feature) is independent, so they are spread over the
cluster.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import EULER_GAMMA, attach_scalar
from tessera.operators.packed import by_key

MI_NEIGHBORS = 3


def mutual_info_knn(long: DataFrame, cell_cols: Sequence[str], n_neighbors: int = MI_NEIGHBORS,
                    x: str = "x", label: str = "label") -> DataFrame:
    """mutual information between a continuous feature and a discrete label
    with the k-nearest-neighbour estimator (Ross 2014), floored at 0.

    Per point: k = min(n_neighbors, N_label − 1); r = distance to the k-th
    nearest same-label point; m = points of any label strictly inside the
    interval (x_i − r, x_i + r) (or equal to x_i when r = 0), self included;
    labels with one point are ignored.  MI = ψ(N) + ⟨ψ(k)⟩ − ⟨ψ(N_label)⟩ − ⟨ψ(m)⟩.
    An interval end that coincides with a same-label neighbour is that
    neighbour's exact value, so the neighbour at distance r is never counted.
    (The interval and |x_j − x_i| < r agree except for values within one
    rounding step of an end; the library adds 1e-10 noise to break such ties,
    which no deterministic engine reproduces.)

    A (cell, feature)'s values and labels travel packed (``packed.by_key``) and
    are worked on sorted; a null label is a label of its own, and the others of
    a point are the points of label 1, or for those all the rest.
    """
    d = long.select(*cell_cols, "feature_idx", F.coalesce(F.col(label).cast("int"), F.lit(NO_LABEL)).alias("y"), F.col(x).cast("double").alias("x"))
    return by_key(d.filter(F.col("x").isNotNull()), [*cell_cols, "feature_idx"], {"x": "double", "y": "int"},
                  lambda xs, ys: _knn_information(xs, ys, n_neighbors), "mi double")


NO_LABEL = -(1 << 31)
POINTS = 500_000  # points whose neighbours a task looks at together


def _digamma(n: np.ndarray) -> np.ndarray:
    """digamma of positive integers; the numpy form of ``harmonic_digamma``."""
    x = np.maximum(np.asarray(n, float), 1.0)
    small = np.concatenate([[0.0, 0.0], np.cumsum(1.0 / np.arange(1, 7))]) - EULER_GAMMA
    inv2 = 1.0 / (x * x)
    series = np.log(x) - 0.5 / x - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return np.where(x < 8, small[np.minimum(x, 7).astype(int)], series)


def _knn_information(x: np.ndarray, y: np.ndarray, n_neighbors: int) -> dict | None:
    """The estimate of ``mutual_info_knn`` for the points of one (cell, feature)."""
    labels, sizes = np.unique(y, return_counts=True)
    kept = np.isin(y, labels[sizes > 1])
    x, y = x[kept], y[kept]
    n = len(x)
    if not n:
        return None
    whole = np.sort(x)
    ones, rest = np.sort(x[y == 1]), np.sort(x[y != 1])
    pk = pl = pm = 0.0
    for v in labels[sizes > 1]:
        own = np.sort(x[y == v])
        others, k = rest if v == 1 else ones, min(n_neighbors, len(own) - 1)
        pk += len(own) * float(_digamma(k))
        pl += len(own) * float(_digamma(len(own)))
        edge = np.full(n_neighbors, np.nan)
        padded = np.concatenate([edge, own, edge])
        for lo in range(0, len(own), POINTS):
            at = own[lo:lo + POINTS]
            near = np.stack([padded[lo + s:lo + s + len(at)] for s in range(2 * n_neighbors + 1)])
            apart = np.abs(near - at)
            r = np.sort(apart, axis=0)[k]  # the point itself comes first, places without a neighbour last
            far = apart == r
            with np.errstate(invalid="ignore"):
                up = np.where(far & (near > at), near, np.inf).min(0)
                down = np.where(far & (near < at), near, -np.inf).max(0)
                hi, low = np.where(np.isfinite(up), up, at + r), np.where(np.isfinite(down), down, at - r)
                m = ((near > low) & (near < hi)).sum(0) + np.searchsorted(others, hi, "left") - np.searchsorted(others, low, "right")
            same = np.searchsorted(whole, at, "right") - np.searchsorted(whole, at, "left")
            pm += float(_digamma(np.where(r > 0, m, same)).sum())
    return {"mi": max(0.0, float(_digamma(n)) + (pk - pl - pm) / n)}


def mutual_info_binned(long: DataFrame, cell_cols: Sequence[str], n_bins: int = 10,
                       x: str = "x", label: str = "label") -> DataFrame:
    """Plug-in mutual information of quantile-binned feature vs label
    (nats): bins from the interpolated k/n_bins quantiles of each (cell,
    feature); a value's bin is the number of edges strictly below it."""
    cc = list(cell_cols)
    cf = [*cc, "feature_idx"]
    qs = F.array(*[F.lit(k / n_bins) for k in range(1, n_bins)])
    edges = long.groupBy(*cf).agg(F.percentile(F.col(x), qs).alias("_e"), F.count(F.lit(1)).alias("_n"))
    b = long.join(edges, cf).withColumn("bin", F.size(F.filter("_e", lambda e: e < F.col(x))))
    cnt = b.groupBy(*cf, "bin", F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("c"), F.first("_n").alias("n"))
    wb = Window.partitionBy(*cf, "bin")
    wy = Window.partitionBy(*cf, "y")
    cnt = cnt.withColumn("cb", F.sum("c").over(wb)).withColumn("cy", F.sum("c").over(wy))
    term = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("cb") * F.col("cy")))
    return cnt.groupBy(*cf).agg(F.sum(term).alias("mi"))


def _mrmr_one(rel: np.ndarray, idx: np.ndarray, absr: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """Greedy MRMR on one cell: argmax relevance, then argmax(relevance − mean
    |r| with the selected); the lowest feature index wins ties."""
    d = len(idx)
    k = min(k, d)
    order = np.argsort(idx, kind="stable")
    rel, idx, absr = rel[order], idx[order], absr[np.ix_(order, order)]
    chosen: list[tuple[int, int, float]] = []
    first = int(np.argmax(rel))
    chosen.append((0, int(idx[first]), float(rel[first])))
    sel = [first]
    red_sum = absr[:, first].copy()
    remaining = np.ones(d, dtype=bool)
    remaining[first] = False
    for step in range(1, k):
        score = rel - red_sum / len(sel)
        score = np.where(remaining, score, -np.inf)
        best = int(np.argmax(score))
        chosen.append((step, int(idx[best]), float(score[best])))
        sel.append(best)
        remaining[best] = False
        red_sum += absr[:, best]
    return chosen


def mrmr(relevance: DataFrame, corr: DataFrame, cell_cols: Sequence[str], k: int = 20) -> DataFrame:
    """MRMR selection of k features per cell (k capped at the feature
    count) from relevance ``(cell…, feature_idx, mi)`` and pairwise
    correlations ``(cell…, i, j, r)`` (i < j; missing pairs count as r = 0).

    The greedy loop is sequential within a cell but only touches a
    features × features table, so each cell is one grouped pandas task and
    all cells run in one job.  Selection for a smaller k is a prefix of the
    selection for a larger k, so fit once with the largest k.
    Returns ``(cell…, step, feature_idx, score)``."""
    cc = list(cell_cols)
    rel = relevance.select(*cc, F.col("feature_idx").cast("int").alias("i"),
                           F.lit(None).cast("int").alias("j"), F.col("mi").alias("v"))
    cr = corr.select(*cc, F.col("i").cast("int"), F.col("j").cast("int"), F.abs("r").alias("v"))
    both = rel.unionByName(cr)
    cell_fields = [f for f in both.schema.fields if f.name in cc]
    schema = T.StructType(cell_fields + [T.StructField("step", T.IntegerType()),
                                         T.StructField("feature_idx", T.IntegerType()),
                                         T.StructField("score", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rp = pdf[pdf["j"].isna()]
        idx = rp["i"].to_numpy(dtype=np.int64)
        pos = {int(f): n for n, f in enumerate(idx)}
        absr = np.zeros((len(idx), len(idx)))
        pr = pdf[pdf["j"].notna()]
        for a, b, v in zip(pr["i"].to_numpy(), pr["j"].to_numpy(), pr["v"].to_numpy()):
            a, b = int(a), int(b)
            if a in pos and b in pos:
                absr[pos[a], pos[b]] = absr[pos[b], pos[a]] = 0.0 if np.isnan(v) else v
        np.fill_diagonal(absr, 1.0)
        out = _mrmr_one(rp["v"].to_numpy(dtype=np.float64), idx, absr, k)
        key = {c: pdf[c].iloc[0] for c in cc}
        return pd.DataFrame({**{c: [v] * len(out) for c, v in key.items()},
                             "step": [o[0] for o in out], "feature_idx": [o[1] for o in out],
                             "score": [o[2] for o in out]})

    return both.groupBy(*cc).applyInPandas(run, schema)


def selection_stability(selected: DataFrame, fit_cols: Sequence[str] = ("repeat",),
                        repeat: str = "repeat", top: int | None = 20) -> DataFrame:
    """F8 + A9 + T3: how often each feature was selected over fits.

    ``freq_per_repeat`` divides by the number of repeats only (the reference
    convention; it can exceed 1 when several models per repeat select the
    feature); ``freq_per_fit`` divides by the number of fits.  Ties in the
    top list break by feature index."""
    fits = selected.select(*fit_cols).distinct()
    totals = fits.agg(F.count(F.lit(1)).alias("_nf"), F.countDistinct(repeat).alias("_nr"))
    c = attach_scalar(selected.groupBy("feature_idx").agg(F.count(F.lit(1)).alias("count")), totals)
    c = (c.withColumn("freq_per_repeat", F.col("count") / F.col("_nr"))
          .withColumn("freq_per_fit", F.col("count") / F.col("_nf")).drop("_nf", "_nr"))
    if top is not None:
        c = c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "feature_idx"))) \
             .filter(F.col("rank") <= top)
    return c
