import bisect
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, hilbert_shards, registry, tokens

from .conftest import SF


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, n, bits):
    side = 1 << bits
    cells = spark.range(side ** n).select(*[((F.col("id") / side ** k).cast("long") % side).cast("int").alias(f"c{k}") for k in range(n)])
    rows = cells.withColumn("h", hilbert_shards.hilbert_index([F.col(f"c{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(side ** n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[k] - b[k]) for k in range(n)) == 1


def test_shards(spark):
    rows = registry.QUERIES["op4_hilbert_shards"](spark, SF).collect()
    docs = {d["doc_id"]: d["text"] or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in order] == sorted(r["hilbert"] for r in rows)


def test_shards_odd_rows(spark, docs_of):
    rows = [(1, None), (1, None), (None, ""), (2, "é" * 100_000), *[(9, "same")] * 30]
    got = hilbert_shards.hilbert_shards(docs_of(rows).withColumn("source", F.lit(None).cast("string")), 4)
    counts = [r["rows"] for r in hilbert_shards.manifest(got).collect()]
    assert sorted(counts) == [8, 8, 9, 9] and {r["size"] for r in got.collect()} == {1, 5, 200_001}
    assert hilbert_shards.hilbert_shards(docs_of([]), 4).count() == 0


def bins(rows, capacity):
    at = defaultdict(list)
    for length, _, n, seq, offset in rows:
        for k in range(n):
            at[seq + k].append((offset, length))
    for v in at.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def best_fit_decreasing(lengths, capacity):
    """The number of sequences, piece by piece."""
    rooms, used = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, length)
        if k < len(rooms):
            free = rooms.pop(k)
        else:
            free, used = capacity, used + 1
        bisect.insort(rooms, free - length)
    return used


def test_best_fit_decreasing():
    assert best_fit_decreasing([6, 5, 5, 4], 10) == 2 and best_fit_decreasing([10, 10, 1], 10) == 3 and best_fit_decreasing([], 10) == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = {int(k): int(rng.integers(0, 30 if seed < 4 else 4000)) for k in rng.choice(np.arange(1, 1025), [5, 60, 300, 1000, 40, 3][seed], replace=False)}
    rows = best_fit_packing.plan(counts)
    for length, n in counts.items():
        own = sorted((a, k) for x, a, k, _, _ in rows if x == length)
        assert sum(k for _, k in own) == n and all(a + k == b for (a, k), (b, _) in zip(own, own[1:]))
    assert bins(rows, 1024) <= 1.002 * best_fit_decreasing([k for k, n in counts.items() for _ in range(n)], 1024)
    assert best_fit_packing.plan({}) == []


def test_packing(spark):
    got = registry.QUERIES["op8_best_fit_packing"](spark, SF).collect()
    docs = {d["doc_id"]: d["text"] or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    enc = tokens.encoder(tokens.VOCABULARY)
    assert by.keys() == docs.keys()
    for (k, text), raw in zip(docs.items(), enc._ids(list(docs.values()))):
        raw += struct.pack("<I", 2)
        own = sorted(by[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(raw) // 4096)))
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(raw[4 * at:4 * (at + r["length"])])
            assert r["length"] == 1024 or r["piece"] == 0
            at += r["length"]
        assert at == len(raw) // 4
    for v in seq.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(seq) <= 1.002 * best_fit_decreasing([r["length"] for r in got], 1024)
    assert best_fit_packing.grouped_plan({}, 1024, 8, 1 / 8) == []


def test_packing_odd_rows(spark, docs_of):
    rows = [(1, None), (1, None), (None, ""), (2, "word " * 5_000), *[(9, "same")] * 30]
    got = best_fit_packing.pack(docs_of(rows)).collect()
    assert sum(r["id"] == 9 for r in got) == 30 and sum(r["id"] is None for r in got) == 1 and sum(r["id"] == 1 for r in got) == 2
    assert best_fit_packing.pack(docs_of([])).count() == 0


def test_the_plan_needs_no_python_process(spark, docs_of):
    packed = best_fit_packing.pack(docs_of([(1, "a b c"), (2, "d"), (3, None)]))
    assert "ExistingRDD" not in packed._jdf.queryExecution().executedPlan().toString()
    assert {r["sequence_id"] for r in packed.collect()} == {0}
    assert best_fit_packing.pack(docs_of([])).collect() == []
