"""SimHash fingerprints and their classes, by pigeonhole blocks.

A text's words (A-Z lower-cased, runs of anything but x20 and x09-x0D) give
3-word shingles, repeats included, each hashed by XXH64 (seed 42); a bit of the
64-bit fingerprint is set if it is set in over half the hashes.

**Pigeonhole blocks.**  A fingerprint is cut into ``distance + 2`` blocks.  Two
fingerprints that differ in at most ``distance`` bits agree in two blocks at
least, so every pair of blocks is a join key (for distance 2: six keys of 32
bits), and fingerprints that share a key are verified by their Hamming distance.
Equal fingerprints are one row before the join.  A bucket yields its classes
(each member with the smallest it is linked to), not its pairs.

**Large buckets.**  A bucket of over ``BUCKET`` fingerprints is not compared pair
by pair.  For distance 2 its members are dealt out once more, exactly: each takes
its own value and every value that differs in one bit outside the shared blocks.
Two members that differ in at most two bits meet at one value, and all that meet
there differ in at most two bits.  A value has 65 members at most, so the work
grows with the number of fingerprints, also inside a group of thousands of near
copies.

Odd rows: a text of fewer words than a shingle is one shingle; null, empty and
blank texts have fingerprint zero and are linked like any other.  Repeated rows
are copies of each other.  A class with null ids only has a null
``component_id``; an empty table gives no rows; other columns are not read.  A
task holds one Arrow batch of texts and the hash bits of ``PIECE`` shingles.
"""
from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, keyed_texts, written
from tessera.llm.components import components

WORDS, SEED, DISTANCE = 3, 42, 2
BUCKET = 64
PIECE = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    own = (text or "").encode().lower().split()  # bytes: only A-Z change, and only x20 and x09-x0D separate
    if not own:
        return 0
    joined, starts = b" ".join(own), [0, *accumulate(len(w) + 1 for w in own)]
    size = min(words, len(own))
    digest, count, total = xxhash.xxh64_digest, np.zeros(64, np.int64), len(own) - size + 1
    for lo in range(0, total, PIECE):
        hi = min(lo + PIECE, total)
        hashes = b"".join([digest(joined[s:e - 1], SEED) for s, e in zip(starts[lo:hi], starts[lo + size:hi + size])])
        count += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``id, fp`` of every row; ``fp`` is the fingerprint's bits as a long."""
    own = keyed_texts(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, fp long")


def _blocks(distance: int) -> list[int]:
    """Masks of 64 bits cut into ``distance + 2`` blocks of nearly equal width."""
    edges = [64 * k // (distance + 2) for k in range(distance + 3)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket_classes(members: np.ndarray, distance: int) -> np.ndarray:
    """For buckets of one size (rows): the smallest column that each member
    reaches over links inside its bucket."""
    near = np.bitwise_count((members[:, :, None] ^ members[:, None, :]).view(np.uint64)) <= distance
    label = np.broadcast_to(np.arange(members.shape[1]), members.shape).copy()
    while True:
        least = np.where(near, label[:, None, :], members.shape[1]).min(2)
        if (least == label).all():
            return label
        label = least


def _verified(buckets: DataFrame, distance: int) -> DataFrame:
    """``a, b``: each member of a bucket with the first of its class there."""

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
            sizes = np.diff(offsets)
            for m in np.unique(sizes):
                first = offsets[:-1][sizes == m]
                for lo in range(0, len(first), 2048):
                    members = np.sort(flat[first[lo:lo + 2048, None] + np.arange(m)], axis=1)
                    label = _bucket_classes(members, distance)
                    linked = label != np.arange(m)
                    heads = np.take_along_axis(members, label, 1)
                    yield pa.RecordBatch.from_arrays([pa.array(heads[linked]), pa.array(members[linked])], ["a", "b"])

    return buckets.select("members").mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links whose connected components are those of all pairs of
    ``nodes`` (distinct ``fp``) that differ in at most ``distance`` bits."""
    masks = [a | b for a, b in combinations(_blocks(distance), 2)]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for k, m in enumerate(masks)])
    keyed = nodes.select("fp", F.explode(keys).alias("key")).select("key.k", "key.v", "fp")
    sizes = keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(keyed.join(sizes, ["k", "v"]))
    if distance > 2:  # the second deal below is exact for two bits
        return _verified(met.groupBy("k", "v").agg(F.collect_list("fp").alias("members")), distance)
    small = met.where(F.col("n") <= BUCKET).groupBy("k", "v").agg(F.collect_list("fp").alias("members"))  # BUCKET at most
    # outside the key's blocks: the bits in which members of one bucket can differ
    bits = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(64) if not m >> b & 1]) for m in masks])
    dealt = met.where(F.col("n") > BUCKET).select("fp", F.explode(bits[F.col("k")]).alias("bit")).distinct()
    at = dealt.select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
    meeting = at.groupBy("value").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)  # 65 at most
    large = meeting.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a != b").distinct()
    return _verified(small, distance).union(large)


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``id, fp, component_id`` of each row; ``component_id`` is the smallest id
    that is reachable over links."""
    rows = written(fingerprints(docs, id_col, text_col, words))
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least")))
    comps = components(links(nodes.select("fp"), distance))
    full = nodes.join(comps, nodes.fp == comps.node, "left").select("fp", "least", F.coalesce("comp", "fp").alias("class"))
    smallest = full.groupBy("class").agg(F.min("least").alias("component_id"))
    of_fp = full.join(smallest, "class").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(of_fp, F.col("fp") == F.col("_fp")).select("id", "fp", "component_id")


def q_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_classes(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
