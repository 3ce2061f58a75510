"""Columns of a long view, packed by key.

Statistics that need all values of a key in order (quantiles, neighbours in one
dimension) get them as numpy arrays.  Tasks pack the values of each key into
binary runs before the shuffle, so that a row costs the bytes of its values and
not those of a row; the runs of a key meet in one group.  A key here is one
feature of one cell: its arrays hold a few bytes for each row of the cell.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PACKED_ROWS = 500_000  # rows that a task holds before it hands on their runs
TYPES = {"double": "<f8", "int": "<i4"}


def _runs(table: pa.Table, keys: Sequence[str], columns: dict[str, str]) -> pa.RecordBatch:
    """One row for each key in ``table`` with its values as bytes, in their order."""
    code = np.zeros(len(table), np.int64)
    for c in keys:
        own = table.column(c).combine_chunks().dictionary_encode()
        code = code * (len(own.dictionary) + 1) + own.indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1
        code = np.unique(code, return_inverse=True)[1]  # so that it never overflows
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.diff(code[order], prepend=-1))
    out = [table.column(c).combine_chunks().take(pa.array(order[first])) for c in keys]
    for c, kind in columns.items():
        values = table.column(c).to_numpy()[order].astype(TYPES[kind])
        places = np.append(first, len(values)).astype(np.int32) * values.itemsize
        out.append(pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(values.tobytes())]))
    return pa.RecordBatch.from_arrays(out, [*keys, *columns])


def by_key(long: DataFrame, keys: Sequence[str], columns: dict[str, str], of: Callable[..., dict | None], result: str) -> DataFrame:
    """``keys…`` and the fields of ``result`` (DDL) for each key: what ``of`` returns
    for the key's arrays, one for each of ``columns`` (name: ``double`` or ``int``,
    without nulls), in any order of rows.  A key for which it returns None has no row."""
    keys = list(keys)
    own = long.select(*keys, *columns)
    shape = T.StructType([own.schema[c] for c in keys] + [T.StructField(c, T.BinaryType()) for c in columns])
    schema = T.StructType([own.schema[c] for c in keys] + T.StructType.fromDDL(result).fields)
    arrow = to_arrow_schema(schema)

    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= PACKED_ROWS:
                yield _runs(pa.Table.from_batches(held), keys, columns)
                held, rows = [], 0
        if rows:
            yield _runs(pa.Table.from_batches(held), keys, columns)

    def met(key, table):
        found = of(*(np.concatenate([np.frombuffer(b.as_buffer(), TYPES[k]) for b in table.column(c)]) for c, k in columns.items()))
        if found is None:
            return arrow.empty_table()
        return pa.Table.from_pylist([{**{c: k.as_py() for c, k in zip(keys, key)}, **found}], schema=arrow)

    return own.mapInArrow(pack, shape).groupBy(*keys).applyInArrow(met, schema)


def interpolated(ordered: np.ndarray, share: float) -> float | None:
    """The interpolated quantile of ordered values, as Spark's ``percentile``."""
    if not len(ordered):
        return None
    at = (len(ordered) - 1) * share
    lo, hi = int(np.floor(at)), int(np.ceil(at))
    a, b = float(ordered[lo]), float(ordered[hi])
    return a if lo == hi or a == b else (hi - at) * a + (at - lo) * b
