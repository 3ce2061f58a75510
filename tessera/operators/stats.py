"""Paired model-comparison statistics over the long metric table.

Ranks, sums and tie terms are window/aggregate expressions; only the final
distribution tails (χ² survival, exact signed-rank tail, normal tail) are a
vectorised pandas UDF over one row per test.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tessera.functions.exprs import attach_scalar

EXACT_MAX_N = 50


def chi2_sf_value(x: float, df: int) -> float:
    """Upper tail of χ² with integer df (closed forms for even and odd df)."""
    if x is None or df is None or df <= 0 or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    h = x / 2.0
    if df % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, df // 2):
            term *= h / i
            total += term
        return math.exp(-h) * total
    total = math.erfc(math.sqrt(h))
    term = math.sqrt(2.0 * x / math.pi) * math.exp(-h)
    for i in range(1, (df - 1) // 2 + 1):
        total += term
        term *= x / (2 * i + 1)
    return total


def signed_rank_tail(n: int, w: float) -> float:
    """P(T+ ≤ w) for the exact null distribution of the signed-rank sum with n
    untied non-zero differences (subset-sum counts over 1..n)."""
    top = n * (n + 1) // 2
    counts = np.zeros(top + 1, dtype=np.float64)
    counts[0] = 1.0
    for k in range(1, n + 1):
        counts[k:] = counts[k:] + counts[:-k]
    return float(counts[: int(math.floor(w)) + 1].sum() / 2.0 ** n)


@pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf_value(float(a), int(b)) if pd.notna(a) and pd.notna(b) else float("nan")
                      for a, b in zip(x, df)])


@pandas_udf(T.DoubleType())
def signed_rank_p(n: pd.Series, w: pd.Series, exact: pd.Series, z: pd.Series) -> pd.Series:
    """Two-sided p: exact tail (×2, capped at 1) or normal tail of |z|."""
    out = []
    for nn, ww, ex, zz in zip(n, w, exact, z):
        if pd.isna(nn) or nn == 0 or pd.isna(ww):
            out.append(1.0)
        elif ex:
            out.append(min(1.0, 2.0 * signed_rank_tail(int(nn), float(ww))))
        else:
            out.append(math.erfc(abs(float(zz)) / math.sqrt(2.0)))
    return pd.Series(out, dtype="float64")


def midrank(order_col, partition) -> F.Column:
    """Average rank of ties (1-based) within ``partition`` ordered by ``order_col``."""
    w = Window.partitionBy(*partition).orderBy(order_col)
    wt = Window.partitionBy(*partition, order_col)
    return F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0


def friedman(metrics: DataFrame, metric: str = "macro_f1", block: str = "repeat",
             treatment: str = "model") -> DataFrame:
    """H1: Friedman χ² with tie correction and its p-value (k−1 df).

    Blocks must be complete (every treatment in every block, once); a missing or
    repeated run raises when the result is computed."""
    v = metrics.select(block, treatment, F.col(metric).cast("double").alias("v"))
    r = v.withColumn("r", midrank(F.col("v"), [block]))
    ties = (v.groupBy(block, "v").agg(F.count(F.lit(1)).alias("t"))
            .agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("tie_sum")))
    rs = r.groupBy(treatment).agg(F.sum("r").alias("R"), F.count(F.lit(1)).alias("nb"))
    s = rs.agg(F.sum(F.col("R") ** 2).alias("ssbn"), F.count(F.lit(1)).alias("k"),
               F.max("nb").alias("n"), F.min("nb").alias("_least"))
    blocks = v.groupBy(block).agg(F.countDistinct(treatment).alias("_t"), F.count(F.lit(1)).alias("_c")).agg(
        F.count(F.lit(1)).alias("_blocks"), F.min("_t").alias("_tmin"), F.max("_c").alias("_cmax"))
    s = attach_scalar(s, blocks)
    whole = (F.col("_least") == F.col("_blocks")) & (F.col("_tmin") == F.col("k")) & (F.col("_cmax") == F.col("k"))
    s = s.withColumn("n", F.when(whole, F.col("n")).otherwise(
        F.raise_error(F.lit("friedman: blocks are incomplete or repeated")).cast("long")))
    k, n = F.col("k"), F.col("n")
    c = F.lit(1.0) - F.col("tie_sum") / (k * (k * k - 1) * n)
    stat = (F.lit(12.0) / (k * n * (k + 1)) * F.col("ssbn") - 3.0 * n * (k + 1)) / c
    out = attach_scalar(s, ties).select(stat.alias("statistic"), (k - 1).alias("df"), "k", "n",
                                   F.col("tie_sum").cast("double").alias("tie_sum"))
    return out.withColumn("p_value", chi2_sf("statistic", "df"))


def paired_differences(metrics: DataFrame, metric: str = "macro_f1", block: str = "repeat",
                       treatment: str = "model", tolerance_digits: int | None = 12) -> DataFrame:
    """All unordered treatment pairs aligned per block (a < b by name).

    Pairs range over the treatment dimension (models of the run grid), whose
    size is set by configuration, not by data volume.  Differences are compared
    at ``tolerance_digits`` decimals, so that sums taken in another order don't
    turn ties into differences; ``None`` ranks the raw differences."""
    a = metrics.select(F.col(block), F.col(treatment).alias("model_a"), F.col(metric).alias("va"))
    b = metrics.select(F.col(block), F.col(treatment).alias("model_b"), F.col(metric).alias("vb"))
    j = a.join(b, [block]).filter(F.col("model_a") < F.col("model_b"))
    d = F.col("va") - F.col("vb")
    return j.select("model_a", "model_b", block,
                    (d if tolerance_digits is None else F.round(d, tolerance_digits)).alias("d"))


def wilcoxon_pairs(metrics: DataFrame, metric: str = "macro_f1", block: str = "repeat",
                   treatment: str = "model", alpha: float = 0.05) -> DataFrame:
    """H2 + H3: two-sided Wilcoxon signed-rank for every model pair, zeros
    dropped, W = min(W+, W−); exact p when there are no zeros and no ties and
    n ≤ 50, else the normal approximation with tie-corrected variance and no
    continuity correction; Bonferroni ``min(1, p·m)``, significant iff < alpha.
    All-zero pairs give statistic NULL and p 1."""
    d = paired_differences(metrics, metric, block, treatment)
    pair = ["model_a", "model_b"]
    nz = d.filter(F.col("d") != 0).withColumn("ad", F.abs("d"))
    ranked = nz.withColumn("r", midrank(F.col("ad"), pair))
    sums = ranked.groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(F.col("d") < 0, F.col("r")).otherwise(0.0)).alias("w_minus"))
    ties = (nz.groupBy(*pair, "ad").agg(F.count(F.lit(1)).alias("t"))
            .groupBy(*pair).agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("tie_sum"),
                                F.max("t").alias("max_tie")))
    zeros = d.groupBy(*pair).agg(F.sum((F.col("d") == 0).cast("int")).alias("n_zero"))
    s = zeros.join(sums, pair, "left").join(ties, pair, "left").fillna(
        {"n": 0, "w_plus": 0.0, "w_minus": 0.0, "tie_sum": 0.0, "max_tie": 0})
    n = F.col("n").cast("double")
    w = F.least("w_plus", "w_minus")
    mn = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - F.col("tie_sum") / 48.0
    z = F.when(var > 0, (w - mn) / F.sqrt(var)).otherwise(F.lit(0.0))
    exact = (F.col("n_zero") == 0) & (F.col("max_tie") <= 1) & (F.col("n") <= EXACT_MAX_N)
    s = s.select(*pair, "n", "n_zero",
                 F.when(F.col("n") == 0, F.lit(None).cast("double")).otherwise(w).alias("statistic"),
                 exact.alias("exact"), z.alias("z"))
    s = s.withColumn("p_value", signed_rank_p("n", "statistic", "exact", "z"))
    return bonferroni(s, alpha).drop("z")


def bonferroni(tests: DataFrame, alpha: float = 0.05, p: str = "p_value") -> DataFrame:
    """H3: ``p_bonferroni = min(1, p·m)`` with m = number of tests."""
    m = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    out = tests.withColumn("p_bonferroni", F.least(F.lit(1.0), F.col(p) * m))
    return out.withColumn("significant", F.col("p_bonferroni") < alpha)
