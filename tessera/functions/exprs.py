"""Column-expression helpers (all JVM-side, codegen friendly)."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the evaluation protocol.
DEFAULT_SEED = 42
THRESHOLD_GRID = (0.05, 0.95, 91)      # F1 threshold search grid: lo, hi, points
CURVE_GRID_POINTS = 200                 # ROC / PR interpolation grid on [0, 1]
VARIANCE_THRESHOLD = 0.01
CORRELATION_THRESHOLD = 0.95
MODEL_ORDER = ("LR", "SVM", "RF", "ET", "GB", "KNN", "Ensemble")
ENSEMBLE_MEMBERS = ("RF", "ET", "GB")
EULER_GAMMA = 0.57721566490153286061


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cols(names: Iterable[str]) -> list[Column]:
    return [F.col(n) for n in names]


def finite_or_null(x: str | Column) -> Column:
    """±inf and NaN become SQL NULL (missing)."""
    c = col(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def array_finite_or_null(arr: str | Column) -> Column:
    return F.transform(col(arr), lambda v: F.when(
        F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double"))
        .otherwise(v.cast("double")))


def clip01(x: str | Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col(x)))


def sigmoid_platt(score: str | Column, a: str | Column, b: str | Column) -> Column:
    """Platt map p = 1 / (1 + exp(a*s + b))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(col(a) * col(score) + col(b)))


def decide(proba: str | Column, threshold: str | Column) -> Column:
    """Inclusive decision predicate ``p >= t`` as int."""
    return (col(proba) >= col(threshold)).cast("int")


def safe_div(num: Column, den: Column, zero: float | None = 0.0) -> Column:
    """num / den with ``zero`` (default 0) when the denominator is 0."""
    fallback = F.lit(zero).cast("double") if zero is not None else F.lit(None).cast("double")
    return F.when(den == 0, fallback).otherwise(num.cast("double") / den.cast("double"))


def grid_value(i: str | Column, lo: float, hi: float, n: int) -> Column:
    """i-th point of an n-point grid on [lo, hi] as the nearest double of the
    decimal value (so 0.35 is 0.35, not 0.35000000000000003); last point is hi."""
    step = (hi - lo) / (n - 1)
    return F.when(col(i) == n - 1, F.lit(hi)).otherwise(
        F.round(F.lit(lo) + col(i).cast("double") * F.lit(step), 12))


def grid_count_le(p: str | Column, lo: float, hi: float, n: int) -> Column:
    """Number of grid points t_i with t_i <= p (0..n), exact w.r.t. grid_value."""
    step = (hi - lo) / (n - 1)
    raw = F.floor((col(p) - F.lit(lo)) / F.lit(step)) + F.lit(1)
    b0 = F.least(F.lit(n), F.greatest(F.lit(0), raw)).cast("int")
    # float guard: move one step if p sits on the other side of a grid point
    up = F.when((b0 < n) & (col(p) >= grid_value(b0, lo, hi, n)), b0 + 1).otherwise(b0)
    return F.when((up > 0) & (col(p) < grid_value(up - 1, lo, hi, n)), up - 1).otherwise(up)


def seeded_key(seed: str | Column, *parts: str | Column) -> Column:
    """md5(seed ':' part1 ':' part2 ...) — a seeded order shared with SQL engines."""
    pieces: list[Column] = [col(seed).cast("string") if not isinstance(seed, (int, float))
                            else F.lit(str(seed))]
    for p in parts:
        pieces.append(F.lit(":"))
        pieces.append(col(p).cast("string"))
    return F.md5(F.concat(*pieces))


def seeded_uniform(seed: int | str | Column, *parts: str | Column) -> Column:
    """Deterministic U[0,1) from md5 (first 13 hex digits = 52 bits)."""
    key = seeded_key(F.lit(str(seed)) if isinstance(seed, int) else seed, *parts)
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def harmonic_digamma(n: str | Column) -> Column:
    """digamma(n) for positive integers: H_{n-1} - gamma.

    Uses the asymptotic series for n >= 8 and exact sums below it
    (abs error < 1e-15 over the integers)."""
    x = col(n).cast("double")
    small = F.aggregate(F.sequence(F.lit(1), F.greatest(col(n).cast("int") - 1, F.lit(1))),
                        F.lit(0.0), lambda acc, k: acc + F.lit(1.0) / k.cast("double"))
    small = F.when(col(n) <= 1, F.lit(0.0)).otherwise(small) - F.lit(EULER_GAMMA)
    inv2 = F.lit(1.0) / (x * x)
    asym = (F.log(x) - F.lit(0.5) / x
            - inv2 * (F.lit(1.0 / 12) - inv2 * (F.lit(1.0 / 120) - inv2 * (
                F.lit(1.0 / 252) - inv2 * (F.lit(1.0 / 240) - inv2 * F.lit(1.0 / 132))))))
    return F.when(col(n) < 8, small).otherwise(asym)


def fmt_mean_std(mean: str | Column, std: str | Column, digits: int = 3) -> Column:
    """Display form ``m ± s``."""
    pattern = f"%.{digits}f ± %.{digits}f"
    return F.format_string(pattern, col(mean), col(std))


def round_doubles(df, digits: int = 9):
    """Round every double column (for engine-neutral comparison)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def attach_scalar(df, scalar_df):
    """Attach the columns of a one-row aggregate (no grouping keys, so exactly
    one row by construction) to every row of ``df`` via a broadcast hash join
    on a constant key."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(scalar_df.withColumn("_one", F.lit(1))), "_one").drop("_one"))
