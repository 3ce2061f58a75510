"""Feature contributions of tree ensembles, and their summary.

``contributions`` are path-dependent Shapley values: a feature that is not in
the coalition lets a row go both ways, by the share of the fit rows (``cover``).
They are exact.  For one leaf, only the distinct features on its path matter:
feature ``f`` passes a row on with ``one_f`` (1 if the row meets all its tests on
the path, else 0) when it is in the coalition and with ``zero_f`` (the product of
the cover shares) when it isn't.  The Shapley weight of a coalition of ``s`` among
``k - 1`` others is the integral of ``t**s (1 - t)**(k - 1 - s)`` over [0, 1], so
the leaf's part is ``one_f - zero_f`` times the integral of the polynomial ``prod
(zero_g (1 - t) + one_g t)`` over the path's other features.  Gauss-Legendre
points give it exactly, so a leaf of ``k`` features costs ``k**2`` for each set
of tests met, whatever the number of rows or coalitions.

Models travel as flat arrays, one for each fit; rows come in blocks
(``cells.block_table``), and each task works through its own blocks.
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.cells import _block, _width, unpacked
from tessera.operators.trees import leaves

PARTS = 16


@lru_cache(maxsize=64)
def _nodes(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on [0, 1] that integrate polynomials of degree k - 1 exactly."""
    t, w = np.polynomial.legendre.leggauss((k + 1) // 2)
    return (t + 1) / 2, w / 2


def _paths(model: dict):
    """Each leaf's ``(value, [(feature, low, high, share)])``: the interval that
    its path allows each feature, and the product of the cover shares there."""
    for root in model["roots"].tolist():
        open_nodes = [(root, {})]
        while open_nodes:
            node, path = open_nodes.pop()
            f = int(model["feature"][node])
            if f < 0:
                yield float(model["value"][node]), path
                continue
            left, cut, whole = int(model["left"][node]), float(model["threshold"][node]), float(model["cover"][node])
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, bounds in ((left, (low, min(high, cut))), (left + 1, (max(low, cut), high))):
                part = float(model["cover"][child]) / whole if whole > 0 else 0.5
                open_nodes.append((child, {**path, f: (*bounds, share * part)}))


def _distinct(code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of ``k`` bits, and the place of each row's code among them."""
    if 1 << k > 8 * len(code):
        return np.unique(code, return_inverse=True)
    there = np.zeros(1 << k, bool)
    there[code] = True
    place = np.cumsum(there) - 1
    return np.flatnonzero(there), place[code]


def tree_contributions(model: dict, x: np.ndarray, scale: float) -> tuple[np.ndarray, float]:
    """``phi`` (rows x features) and the base: the sum over trees times ``scale``.
    ``phi`` of a row plus the base is the ensemble's output for it.

    A leaf works on the distinct sets of tests that rows meet, known by one bit
    for each feature of the path; the products of the other features' factors,
    from both ends, are polynomials in t, and ``_nodes`` integrates them exactly."""
    phi, base, columns = np.zeros(x.shape[::-1]), 0.0, np.ascontiguousarray(x.T)
    for value, path in _paths(model):
        k = len(path)
        zero = np.array([path[f][2] for f in path])
        base += value * zero.prod()
        if not k or not value:
            continue
        code, tests = np.zeros(len(x), np.int64), []
        for j, (f, (low, high, _)) in enumerate(path.items()):
            meets = columns[f] <= high
            if low > -np.inf:
                meets &= columns[f] > low
            if k > 62:  # more bits than a code has: every row for itself
                tests.append(meets)
            else:
                code |= meets.astype(np.int64) << j
        if tests:
            met, back = np.stack(tests).astype(float), np.arange(len(x))
        else:
            codes, back = _distinct(code, k)
            met = ((codes >> np.arange(k)[:, None]) & 1).astype(float)
        t, weights = _nodes(k)
        factor = zero[:, None, None] * (1 - t)[:, None] + met[:, None, :] * t[:, None]  # features, nodes, sets
        before, after = np.ones_like(factor), np.ones_like(factor)
        for j in range(1, k):
            np.multiply(before[j - 1], factor[j - 1], out=before[j])
            np.multiply(after[k - j], factor[k - j], out=after[k - j - 1])
        before *= after
        part = value * np.einsum("q,jqs->js", weights, before) * (met - zero[:, None])
        for f, own in zip(path, part):
            phi[f] += own[back]
    return phi.T * scale, base * scale


def output_scale(model: dict) -> tuple[float, float]:
    """(factor of the sum over trees, constant): a forest's mean, a booster's margin."""
    return (1.0, float(model["base"])) if "base" in model else (1.0 / len(model["roots"]), 0.0)


def contributions(blocks: DataFrame, fits: DataFrame, models: DataFrame, cell: Sequence[str]) -> DataFrame:
    """``fit, <cell columns of blocks>, row_id, base, output, phi`` of every
    row for each fit of its cell; ``phi`` follows the order of the features, and
    ``base`` plus its sum is ``output`` (P(class 1); the margin of a booster).
    The trees of a fit are dealt into ``PARTS`` tasks for each block, and the
    parts' sums meet by block."""
    own = [c for c in blocks.columns if c not in ("block", "blocks", "n", "x", "y", "w", "key")]
    work = blocks.join(fits.select("fit", *cell, "program", "params").join(models, "fit"), list(cell))
    work = work.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).repartition("fit", *own, "block", "part")
    names = [*own, "fit", "block"]
    parts = T.StructType([work.schema[c] for c in names] + [T.StructField(c, t) for c, t in (
        ("key", T.BinaryType()), ("base", T.DoubleType()), ("output", T.BinaryType()), ("phi", T.BinaryType()))])
    schema = T.StructType([blocks.schema[c] for c in own] + [T.StructField(c, t) for c, t in (
        ("fit", T.IntegerType()), ("row_id", T.LongType()), ("base", T.DoubleType()), ("output", T.DoubleType()), ("phi", T.ArrayType(T.DoubleType())))])
    arrow_parts, arrow = to_arrow_schema(parts), to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                params, model = json.loads(row["params"]), unpacked(row["model"])
                b = _block(row, (row["fit"], row["block"]), _width(params, len(row["x"]) // 8 // max(1, row["n"])))
                scale, constant = output_scale(model)
                some = {**model, "roots": model["roots"][row["part"]::PARTS]}
                phi, base = tree_contributions(some, b.x, scale)
                told = model["value"][leaves(some, b.x)].sum(1) * scale + (constant if row["part"] == 0 else 0.0)
                out = {c: [row[c]] for c in names}
                out.update(key=[row["key"]], base=[base + (constant if row["part"] == 0 else 0.0)], output=[told.tobytes()], phi=[phi.tobytes()])
                yield pa.RecordBatch.from_pydict(out, schema=arrow_parts)

    def add(keys, table):
        ids = np.frombuffer(table.column("key")[0].as_py(), "<i8")
        output, phi = (sum(np.frombuffer(v.as_py(), "<f8") for v in table.column(c)) for c in ("output", "phi"))
        out = {c: [k.as_py()] * len(ids) for c, k in zip([*own, "fit"], keys)}
        out.update(row_id=ids, base=[sum(table.column("base").to_pylist())] * len(ids), output=output, phi=list(phi.reshape(len(ids), -1)))
        return pa.table(out, schema=arrow)

    return work.mapInArrow(run, parts).groupBy(*names).applyInArrow(add, schema)


def mean_contributions(phi: DataFrame, by: Sequence[str], support: DataFrame) -> DataFrame:
    """``by…, feature_idx, mean_abs`` over rows; ``support`` holds ``by…,
    sel``, the feature behind each place of ``phi``."""
    long = phi.join(support, list(by)).select(*by, F.posexplode("phi").alias("p", "v"), "sel")
    return long.groupBy(*by, F.col("sel")[F.col("p")].alias("feature_idx")).agg(F.avg(F.abs("v")).alias("mean_abs"))


def top_features(importance: DataFrame, by: Sequence[str], n: int = 10, value: str = "mean_abs") -> DataFrame:
    """The ``n`` features of the largest values, with ``rank`` from 1;
    the lower feature index wins ties."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), "feature_idx")  # as many rows as features
    return importance.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
