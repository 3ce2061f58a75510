"""Whitening of embeddings from the exact characteristic polynomial.

Vectors become integers, ``x = floor(scale * c)``.  Over the distinct vectors
(the fit list: ``n`` of them, sums ``S``) Spark adds up the exact scatter
``A = n * sum(x x') - S S'``, which is ``n**2`` times their covariance.

1. **Polynomial.**  The characteristic polynomial of ``A`` modulo many primes of
   31 bits, each by reduction to Hessenberg form; primes are rows of a DataFrame
   and tasks work on them.  Their number follows from a bound on the
   coefficients, so Chinese remaindering gives the integers exactly.
2. **Roots.**  All roots are real, so by Budan's theorem the sign changes of the
   polynomial shifted to ``t`` count the roots above ``t``, with multiplicity and
   without error.  Bisection on these counts encloses the largest eigenvalues
   one by one until each is known to ``DIGITS`` bits more than it has.  The
   lowest coefficients that vanish give the rank.
3. **Components.**  Null vectors of ``A - e`` by inverse iteration with decimal
   arithmetic of as many digits, in tasks; equal eigenvalues get an orthonormal
   basis of their space.  Each is unit to double precision, with its largest
   entry positive.

Vectors are then centred as integers (``n * x - S``), projected, and divided by
the root of the eigenvalue, in one map.

Odd rows: a row is left out if its vector is null or holds a null, NaN or
infinite entry; repeated rows and equal vectors count once in the fit list, and
each row is returned.  Vectors shorter than the longest are filled with zeros.
Only components with an eigenvalue above zero exist (one vector, or equal ones:
none, so no rows).  Values beyond a long's range are cut to it, and a
``deviation`` that doesn't fit a long is null.  An empty table gives no rows;
null ids stay; other columns are not read.  The driver holds the scatter
(dimensions squared) and the polynomial, never rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written

SCALE, COMPONENTS = 256, 4
DIGITS = 160
SAFE = 1 << 53


# ---------------------------------------------------------------- exact sums
def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``id, x``: the rows that remain, with integer vectors of one length."""
    own = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = own.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    x = whole.select("id", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    lengths = x.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if lengths["hi"] is not None and lengths["lo"] != lengths["hi"]:
        x = x.select("id", F.slice(F.concat("x", F.array_repeat(F.lit(0).cast("long"), lengths["hi"])), 1, lengths["hi"]).alias("x"))
    return x


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1) if len(column) and len(flat) else np.zeros((len(column), 0), np.int64)


def _products(x: np.ndarray) -> np.ndarray:
    """``x' x`` as exact Python integers: float products of so few rows at a time
    that no sum leaves the exact range, or integer arithmetic for large values."""
    top = int(np.abs(x.astype(object)).max()) if x.size else 0
    if top * top >= SAFE:
        y = x.astype(object)
        return y.T @ y
    step, total = max(1, SAFE // max(1, top * top)), np.zeros((x.shape[1],) * 2, object)
    for lo in range(0, len(x), step):
        part = x[lo:lo + step].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def scatter(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """``n``, ``S`` and ``A`` of the fit list (column ``x``), exactly.

    Each task adds up its own rows; one row per matrix entry travels, as a
    decimal in two halves, and the driver gets the sums."""
    half = 1 << 62

    def partial(batches):
        n, sums, products = 0, None, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            s, p = x.astype(object).sum(0), _products(x)
            n, sums, products = n + len(x), s if sums is None else sums + s, p if products is None else products + p
        if not n:
            return
        d = len(sums)
        i, j = np.triu_indices(d)
        cells = [(-1, -1, n), *((-1, k, int(sums[k])) for k in range(d)), *((int(a), int(b), int(products[a, b])) for a, b in zip(i, j))]
        a, b, v = zip(*cells)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([y // half for y in v], pa.decimal128(38, 0)),
                                          pa.array([y % half for y in v], pa.decimal128(38, 0))], ["i", "j", "hi", "lo"])

    parts = fit.select("x").mapInArrow(partial, "i int, j int, hi decimal(38,0), lo decimal(38,0)")
    cells = parts.groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()
    value = {(r["i"], r["j"]): int(r["hi"]) * half + int(r["lo"]) for r in cells}
    n = value.pop((-1, -1), 0)
    sums = [value[k] for k in sorted(k for k in value if k[0] == -1)]
    d = len(sums)
    a = np.zeros((d, d), object)
    for (i, j), v in value.items():
        if i >= 0:
            a[i, j] = a[j, i] = n * v - sums[i] * sums[j]
    return n, sums, a


# ---------------------------------------------------------------- polynomial
def _primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (under 2**32: three bases decide)."""

    def prime(m: int) -> bool:
        if m % 2 == 0:
            return m == 2
        d, r = m - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        for base in (2, 7, 61):
            y = pow(base, d, m)
            if base % m and y not in (1, m - 1) and not any((y := y * y % m) == m - 1 for _ in range(r - 1)):
                return False
        return m > 1

    out, m = [], top - 1
    while len(out) < count:
        if prime(m):
            out.append(m)
        m -= 1
    return out


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(t - a) modulo a prime below 2**31."""
    h, d = a.copy(), len(a)
    for m in range(1, d - 1):  # similar Hessenberg matrix, column by column
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        k = m + int(below[0])
        if k != m:
            h[[m, k]] = h[[k, m]]
            h[:, [m, k]] = h[:, [k, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k x k part
    poly[0, 0] = 1
    for k in range(1, d + 1):
        row = np.roll(poly[k - 1], 1)
        row[0] = 0
        row = (row - h[k - 1, k - 1] * poly[k - 1]) % p
        weight = np.zeros(k - 1, np.int64)
        along = 1
        for i in range(k - 2, -1, -1):
            along = along * int(h[i + 1, i]) % p
            weight[i] = along * int(h[i, k - 1]) % p
        if k > 1:
            row = (row - (weight[:, None] * poly[:k - 1] % p).sum(0)) % p
        poly[k] = row
    return poly[d]


def characteristic(spark: SparkSession, a: np.ndarray) -> list[int]:
    """The exact coefficients of det(t - a), constant first, of a symmetric
    positive semidefinite integer matrix."""
    d = len(a)
    trace = sum(int(a[k, k]) for k in range(d))
    bound = max(math.comb(d, k) * Fraction(trace, max(1, d)) ** k for k in range(d + 1))  # Maclaurin's inequality
    bits = int(2 * bound + 1).bit_length()
    primes = _primes_below(1 << 31, bits // 30 + 1)
    sent = spark.sparkContext.broadcast(a)  # dimensions squared

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"p": [p], "c": [polynomial_mod((sent.value % p).astype(np.int64), p).tolist()]})

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks, "p").mapInArrow(run, "p long, c array<bigint>").collect()
    sent.unpersist()
    whole = math.prod(primes)
    share = [(whole // r["p"]) * pow(whole // r["p"], -1, r["p"]) for r in rows]
    out = []
    for k in range(d + 1):
        c = sum(r["c"][k] * s for r, s in zip(rows, share)) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


# ---------------------------------------------------------------- roots
def _above(poly: list[int], t: int, shift: int) -> int:
    """How many roots of a real-rooted polynomial are above ``t / 2**shift``."""
    d = len(poly) - 1
    c = [v << (shift * (d - k)) for k, v in enumerate(poly)]  # roots times 2**shift
    for i in range(d):  # Taylor shift by t
        for k in range(d - 1, i - 1, -1):
            c[k] += t * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], t: int, shift: int) -> int:
    d, v = len(poly) - 1, 0
    for k in range(d, -1, -1):
        v = v * t + (poly[k] << (shift * (d - k)))
    return (v > 0) - (v < 0)


def largest_roots(poly: list[int], count: int, digits: int = DIGITS) -> list[tuple[Fraction, int]]:
    """``(root, multiplicity)`` in falling order, of the positive roots that the
    first ``count`` components need; each root to ``digits`` significant bits.
    Roots that agree to that many bits are one root."""
    zero = next(k for k, c in enumerate(poly) if c)
    poly = poly[zero:]
    left, out = min(count, len(poly) - 1), []
    if left <= 0:
        return out
    top = 1 << max(1, (abs(poly[-2])).bit_length())  # the sum of the roots bounds each
    done = 0
    while done < left:
        # the (done + 1)-th root is in (lo, hi] / 2**shift
        lo, hi, shift, single = 0, top, 0, False
        over_lo, over_hi = len(poly) - 1, 0
        while True:
            if hi - lo <= lo >> digits:
                break
            if hi - lo == 1:
                lo, hi, shift = 2 * lo, 2 * hi, shift + 1
            mid = (lo + hi) // 2
            if over_lo - over_hi == 1:  # one root left: the sign tells its side
                if not single:
                    single, high = True, _sign(poly, hi, shift)
                    if high == 0:
                        lo = hi - 1
                        break
                s = _sign(poly, mid, shift)
                if s == 0:
                    lo, hi = mid - 1, mid
                    break
                lo, hi = (lo, mid) if s == high else (mid, hi)
                continue
            over = _above(poly, mid, shift)
            if over > done:
                lo, over_lo = mid, over
            else:
                hi, over_hi = mid, over
        out.append((Fraction(hi, 1 << shift), over_lo - over_hi))
        done = over_lo
    return out


# ---------------------------------------------------------------- components
def null_vectors(a: np.ndarray, root: Fraction, count: int, digits: int = DIGITS) -> list[list[float]]:
    """Orthonormal vectors of the space of ``root``, ``count`` of them."""
    d = len(a)
    with localcontext() as ctx:
        ctx.prec = int((digits + max(1, int(a.max()).bit_length())) * 0.302) + 20
        # a shift beside the root by far less than any gap that counts
        e = Decimal(root.numerator) / Decimal(root.denominator)
        e += e.scaleb(-int(digits * 0.302) - 6)
        rows = [[Decimal(int(v)) for v in r] for r in a]
        for k in range(d):
            rows[k][k] -= e
        steps = []  # elimination with row exchange
        for k in range(d):
            pivot = max(range(k, d), key=lambda r: abs(rows[r][k]))
            rows[k], rows[pivot] = rows[pivot], rows[k]
            if not rows[k][k]:
                rows[k][k] = Decimal(1).scaleb(-ctx.prec)
            factors = [rows[r][k] / rows[k][k] for r in range(k + 1, d)]
            for r, f in zip(range(k + 1, d), factors):
                if f:
                    own, base = rows[r], rows[k]
                    for c in range(k + 1, d):
                        own[c] -= f * base[c]
            steps.append((pivot, factors))

        def solve(b: list[Decimal]) -> list[Decimal]:
            b = list(b)
            for k, (pivot, factors) in enumerate(steps):
                b[k], b[pivot] = b[pivot], b[k]
                for r, f in zip(range(k + 1, d), factors):
                    b[r] -= f * b[k]
            for k in range(d - 1, -1, -1):
                b[k] = (b[k] - sum((rows[k][c] * b[c] for c in range(k + 1, d)), Decimal(0))) / rows[k][k]
            return b

        def unit(b: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for o in others * 2:
                along = sum((x * y for x, y in zip(b, o)), Decimal(0))
                b = [x - along * y for x, y in zip(b, o)]
            size = sum((x * x for x in b), Decimal(0)).sqrt()
            return [x / size for x in b]

        found: list[list[Decimal]] = []
        for k in range(count):
            v = unit([Decimal(1 + (k + 1) * (r + 1) * (r + 2 * k + 3) % 7919) for r in range(d)], found)
            for _ in range(3):
                v = unit(solve(v), found)
            if max(v, key=abs) < 0:
                v = [-x for x in v]
            found.append(v)
        return [[float(x) for x in v] for v in found]


class Whitening:
    """``n``, ``sums``, the exact eigenvalues of the scatter and its vectors."""

    def __init__(self, n: int, sums: list[int], trace: int, roots: list[Fraction], vectors: np.ndarray):
        self.n, self.sums, self.trace, self.roots, self.vectors = n, sums, trace, roots, vectors

    def explained(self) -> list[float]:
        return [float(r / self.trace) for r in self.roots]

    def project(self, column: pa.Array) -> tuple[list[int | None], np.ndarray]:
        """``deviation`` and whitened coordinates (rows x components) of integer vectors."""
        x = _matrix(column)
        sums = np.array(self.sums, object)
        most = (int(np.abs(x.astype(object)).max()) if x.size else 0) * self.n + max(map(abs, self.sums), default=0)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            centred = x * self.n - sums.astype(np.int64)
            deviation = (centred * centred).sum(1).tolist()
        else:
            centred = x.astype(object) * self.n - sums
            deviation = [v if v < 1 << 63 else None for v in (int((r * r).sum()) for r in centred)]
        scale = np.array([math.sqrt(r) if r < 1 << 1000 else float(math.isqrt(int(r))) for r in self.roots])
        return deviation, centred.astype(float) @ self.vectors.T / scale


def fitted(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening of a fit list (distinct ``x``)."""
    spark = fit.sparkSession
    n, sums, a = scatter(fit)
    trace = sum(int(a[k, k]) for k in range(len(a)))
    if not trace:
        return Whitening(n, sums, 0, [], np.zeros((0, len(sums))))
    found = largest_roots(characteristic(spark, a), components)
    sent = spark.sparkContext.broadcast(a)

    def run(batches):
        for pdf in batches:
            for k, root, count in zip(pdf["k"], pdf["root"], pdf["count"]):
                vectors = null_vectors(sent.value, Fraction(root), int(count))
                yield pd.DataFrame({"k": [k] * len(vectors), "part": range(len(vectors)), "v": vectors})

    work, left = [], components
    for k, (root, count) in enumerate(found):
        work.append((k, str(root), min(count, left)))
        left -= min(count, left)
    rows = spark.createDataFrame(work, "k int, root string, count int").repartition(len(work), "k").mapInPandas(run, "k int, part int, v array<double>").collect()
    sent.unpersist()
    rows.sort(key=lambda r: (r["k"], r["part"]))
    return Whitening(n, sums, trace, [found[r["k"]][0] for r in rows], np.array([r["v"] for r in rows]))


def _projected(model: Whitening, rows: DataFrame) -> DataFrame:
    """``id, deviation, w``: the whitened coordinates of rows ``id, x``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            deviation, w = model.project(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), pa.array(w.tolist(), pa.list_(pa.float64()))], ["id", "deviation", "w"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, deviation long, w array<double>")


def identity_error(model: Whitening, fit: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.roots)
    if not k:
        return 0.0
    w = _projected(model, fit.select(F.lit(None).cast("long").alias("id"), "x"))
    means = w.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    centred = [F.col("w")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = w.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cov[q] - (i == j)) for q, (i, j) in enumerate(pairs))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each remaining row and component: ``id, component, n,
    deviation, whitened, explained, identity_error``."""
    x = written(integer_vectors(rows, id_col, vector_col, scale))
    fit = written(x.select("x").distinct())
    model = fitted(fit, components)
    error = identity_error(model, fit)
    parts = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.col("w")[k].alias("whitened"), F.lit(share).alias("explained"))
                      for k, share in enumerate(model.explained())]) if model.roots else F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    out = _projected(model, x).select("id", "deviation", F.explode(parts).alias("c"))
    return out.select("id", F.col("c.component").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumnRenamed("id", "vec_id")
