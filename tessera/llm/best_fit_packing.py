"""Packing of documents into sequences by linear grouping, then best fit.

Only documents longer than a sequence are cut: into full pieces, the first
piece taking the rest.  So every piece has one of ``capacity`` lengths, and the
whole plan is made from the count of each length, which is all that reaches the
driver (``capacity`` numbers at most):

1. full pieces are sequences of their own;
2. large lengths are sorted and dealt into groups of equal cardinality, and
   rounded up to the largest of their group;
3. the few rounded sizes form a cutting-stock problem, whose relaxation is
   solved over configurations by column generation; each configuration is used
   its whole number of times at most;
4. actual pieces take the places of the rounded ones: at each place the longest
   one left that keeps room for the places behind it.  A configuration is used
   only while its actual pieces fill as much as its rounded ones would;
5. what remains, small pieces above all, goes longest first into the sequences
   with the least sufficient room, or into new ones.

The plan of fewest sequences over a few numbers of groups is taken.

Sequences with the same filling are handled as one range, so the plan is a
table of (length, first rank, count, first sequence, offset).  Its size depends
on ``capacity`` and not on the documents, and it is broadcast.  Spark numbers
the pieces of each length (``exact_ranks``; a length shared by a third of all
pieces is spread out) and looks up each piece's place.

A null text is empty and has only the end id; repeated rows are packed as often
as they come; an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, exact_ranks, keyed_texts, written
from tessera.llm.tokens import END, VOCABULARY, encoded

CAPACITY, GROUPS, LARGE = 1024, (8, 16, 32), 1 / 8


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` for each piece of each row."""
    own = keyed_texts(docs, id_col, text_col)

    def cut(batches):
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(encoded(batch.column(1), vocabulary)):
                ids += struct.pack("<I", end)
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(k)
                    piece.append(j)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a:4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])
        pa.default_memory_pool().release_unused()  # the process outlives the task, beside those of later stages

    return own.mapInArrow(cut, f"id {own.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within capacity of the greatest value (unbounded knapsack)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        for k, s in enumerate(sizes):
            if s <= room and best[room - s] + values[k] > best[room] + 1e-12:
                best[room], last[room] = best[room - s] + values[k], k
    config, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            config[last[room]] += 1
            room -= sizes[last[room]]
    return best[capacity], config


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """(times, configuration) pairs that cover at most ``demand``: the cutting-stock
    relaxation by column generation, each configuration's times rounded down."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    times = np.array(demand, float) / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, config = _best_configuration(sizes, prices, capacity)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, config)
        ratio = np.where(step > 1e-9, times / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        times = np.maximum(times - ratio[out] * step, 0)
        times[out], basis[:, out] = ratio[out], config
    left, plan = np.array(demand), []
    for k in np.argsort(-times):
        use = basis[:, k].astype(int)
        m = min([int(times[k] + 1e-6), *(left[use > 0] // use[use > 0]).tolist()])
        if m > 0:
            left = left - m * use
            plan.append((m, use))
    return plan


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: Sequence[int] = GROUPS, large: float = LARGE) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, count, first sequence, offset) for all pieces: the
    plan of fewest sequences over the numbers of groups tried (the first of equals)."""
    tried = [grouped_plan(counts, capacity, g, large) for g in groups]
    return min(tried, key=lambda rows: max((seq + n for _, _, n, seq, _ in rows), default=0))


def grouped_plan(counts: dict[int, int], capacity: int, groups: int, large: float) -> list[tuple[int, int, int, int, int]]:
    """The plan with the large lengths in ``groups`` groups of equal cardinality."""
    left, rank, rows = {k: v for k, v in counts.items() if v}, dict.fromkeys(counts, 0), []
    rooms: dict[int, list[tuple[int, int]]] = {}  # free room -> (first sequence, count)
    sequences = 0

    def put(length: int, seq: int, n: int, free: int) -> None:
        rows.append((length, rank[length], n, seq, capacity - free))
        rank[length] += n
        left[length] -= n

    if left.get(capacity):
        n = left[capacity]
        put(capacity, 0, n, capacity)
        sequences = n

    # linear grouping of the large lengths
    total = sum(v for k, v in left.items() if k > large * capacity)
    members: list[list[list[int]]] = []
    if total:
        each = -(-total // groups)
        room = 0
        for length in sorted((k for k, v in left.items() if k > large * capacity and v), reverse=True):
            n = left[length]
            while n:
                if room == 0:
                    members.append([])
                    room = each
                k = min(n, room)
                members[-1].append([length, k])
                n, room = n - k, room - k
    demand: dict[int, int] = {}
    for g in members:
        demand[g[0][0]] = demand.get(g[0][0], 0) + sum(n for _, n in g)
    sizes = sorted(demand, reverse=True)
    for times, config in configurations(sizes, [demand[s] for s in sizes], capacity) if sizes else []:
        slots = [sizes[k] for k, copies in enumerate(config) for _ in range(int(copies))]
        while times:
            own, free, after = Counter(), capacity, sum(slots)
            for size in slots:  # the longest actual piece that leaves the places behind it their sizes
                after -= size
                length = next((k for k in range(free - after, int(large * capacity), -1) if left.get(k, 0) > own[k]), 0)
                own[length] += 1
                free -= length
            del own[0]
            if capacity - free < sum(slots):
                break  # too few actual pieces are left to fill it as planned
            n = min(times, *(left[k] // c for k, c in own.items()))
            room = capacity
            for length, copies in own.items():
                for k in range(copies):
                    put(length, sequences, n, room)
                    room -= length
            rooms.setdefault(free, []).append((sequences, n))
            sequences, times = sequences + n, times - n

    for length in sorted((k for k, v in left.items() if v), reverse=True):  # best fit, longest first
        while left[length]:
            free = min((f for f, v in rooms.items() if f >= length and v), default=None)
            if free is None:
                n = -(-left[length] // (capacity // length))
                rooms.setdefault(capacity, []).append((sequences, n))
                sequences += n
                continue
            seq, n = rooms[free].pop()
            m = min(n, left[length])
            put(length, seq, m, free)
            rooms.setdefault(free - length, []).append((seq, m))
            if n > m:
                rooms[free].append((seq + m, n - m))
    return rows


def _plan_table(rows: list[tuple[int, int, int, int, int]]) -> pa.Table:
    """Arrow's form: Spark takes it as it is, where a list of rows would go through
    Python processes on the executors, which outlast the job."""
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return pa.Table.from_arrays([pa.array(c) for c in columns], ["_length", "_rank", "_n", "_seq", "_offset"])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` of each piece."""
    spark = docs.sparkSession
    cut = written(pieces(docs, id_col, text_col, capacity, vocabulary, end))
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = spark.createDataFrame(_plan_table(plan(counts, capacity)))
    ranked = exact_ranks(cut, ["length"], ["id", "piece", "ids_crc32"])
    here = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_rank")) & (F.col("rank") < F.col("_rank") + F.col("_n"))
    return ranked.join(F.broadcast(table), here).select(  # the plan's size depends on the capacity alone
        "id", "piece", "start", "length", "ids_crc32",
        (F.col("_seq") + F.col("rank") - F.col("_rank")).alias("sequence_id"), F.col("_offset").alias("offset"))


def q_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
