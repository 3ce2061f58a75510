"""Alignment of two tokenizers' tokens, with external spill counting of id pairs.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces
with byte fallback) the text, to which it adds the space itself.  Both cover the
same bytes; where a token of each ends, the text is cut into groups, and an A
and a B token are linked where their byte ranges overlap.  A pair of ids counts
in how many documents it is linked; a link is a best one if its pair's count is
the highest of its A id.

**Records and runs.**  Both tokenizers start a new token at a plain space that
stands between two characters that are not white space, so such chunks are
aligned alone, and each process keeps the alignment of chunks that it met (a
bounded number).  The map over the texts puts up to ``BLOCK_DOCS`` documents into
a block and turns its links into records (A id, B id, document, times), dealt by
radix (A id modulo ``RADIX``), sorted side-major (by A, then B, then document)
and stored as one zstd run for each block and radix.  Digests and runs are
written once; no text is encoded twice.

**Counting.**  The runs of a radix are dealt into groups of about
``GROUP_RECORDS`` records, by their number of records, so that neither a frequent
id nor a large corpus fills a task.  A k-way merge over a heap of block heads
counts the pairs of a group; Spark adds up the groups' counts.  Since a radix
holds all pairs of its A ids, one side-major pass gives the maxima.

**Contributions.**  Each group meets the counts of its radix, runs through its
records once more in the same order, and streams to each block the counts and
best links of its documents, summed by document; a block adds up what its runs
return.

Odd rows: null and empty texts, and texts whose tokens of A or B don't spell the
space and the text, have no tokens: zeros, and an empty ``groups_sha256``.  Each
row is a document, repeated rows too; null ids stay; an empty table gives no
rows; other columns are not read.  Strings of special tokens are plain text.  A
very long text is a block of its own.  A task holds one block, one group of
records, or the counts of one radix (at most the id pairs of 1 / ``RADIX`` of
A's vocabulary).
"""
from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, keyed_texts, written
from tessera.llm.tokens import BYTE_CHARS, ODD, Encoder

SIDE_A = public_tokenizers.path("byte_bpe_50k.json")
SIDE_B = public_tokenizers.path("piece_bpe_32k.model")
KEPT = 300_000
RADIX = 64
BLOCK_DOCS, BLOCK_CHARS = 1 << 11, 1 << 22  # a document's place in its block takes 11 bits, an id 21 at most
GROUP_RECORDS = 2_000_000
STEP = 1 << 12
SHIFT = np.int64(32)  # a pair of ids as one long: A above B


# ---------------------------------------------------------------- alignment
class _Plain(Encoder):
    """Ids by a byte-level vocabulary; strings of added tokens are plain text."""

    def __init__(self, file: str):
        super().__init__(file)
        self.tokenizer.encode_special_tokens = True
        self.added = []
        back = {c: b for b, c in BYTE_CHARS.items()}
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        self.spelled: list[bytes] = [b""] * len(self.lengths)
        for piece, i in self.tokenizer.get_vocab().items():
            spelled = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
            self.spelled[i], self.lengths[i] = spelled, len(spelled)


class Aligner:
    """Aligned chunks: ``(pairs, n_a, groups)`` each, or None for a chunk that
    its tokens don't spell."""

    def __init__(self, file_a: str, file_b: str):
        import sentencepiece

        self.a, self.b = _Plain(file_a), sentencepiece.SentencePieceProcessor(model_file=file_b)
        self.spelled: list[bytes] = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(p) for p in self.spelled], np.int64)
        # an id as text with what may follow it: inside a list, at the end of A's list, of B's
        self.inner, self.end_a, self.end_b = ([b"%d%s" % (i, mark) for i in range(max(len(self.lengths), len(self.a.lengths)))] for mark in (b",", b"|", b";"))
        self.known: dict[str, tuple | None] = {}

    def _chunks(self, chunks: list[str]) -> dict[str, tuple | None]:
        """Alignments of chunks; each begins with the space that B adds itself."""
        out: dict[str, tuple | None] = {}
        for lo in range(0, len(chunks), 1 << 15):
            own = chunks[lo:lo + (1 << 15)]
            encoded = self.a._chunks(own)
            ids_a = [np.frombuffer(encoded[c], "<u4") for c in own]
            ids_b = self.b.encode([c[1:] for c in own], num_threads=1)
            good = [self._spells(c.encode(), x.tolist(), y) for c, x, y in zip(own, ids_a, ids_b)]
            out.update((c, None) for c, g in zip(own, good) if not g)
            if any(good):
                out.update(self._aligned([c for c, g in zip(own, good) if g], [x for x, g in zip(ids_a, good) if g], [y for y, g in zip(ids_b, good) if g]))
        return out

    def _spells(self, whole: bytes, ids_a: list[int], ids_b: list[int]) -> bool:
        a, b = self.a.spelled, self.spelled
        return b"".join([a[i] for i in ids_a]) == whole == b"".join([b[i] for i in ids_b])

    def _aligned(self, chunks: list[str], ids_a: list[np.ndarray], ids_b: list[list[int]]) -> Iterator[tuple[str, tuple]]:
        """Chunks laid end to end are aligned at once: a chunk's end is a cut."""
        n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(y) for y in ids_b])
        a, b = np.concatenate(ids_a).astype(np.int64), np.fromiter((i for y in ids_b for i in y), np.int64, n_b.sum())
        ends_a, ends_b = self.a.lengths[a].cumsum(), self.lengths[b].cumsum()
        ends = np.union1d(ends_a, ends_b)  # each stretch between two ends lies in one token of each side
        pairs = (a[np.searchsorted(ends_a, ends)] << SHIFT | b[np.searchsorted(ends_b, ends)]).astype("<i8").tobytes()
        close = ends_a[n_a.cumsum() - 1]
        links = np.searchsorted(ends, close, side="right")
        cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        last_a, last_b = np.isin(ends_a, cuts, assume_unique=True).tolist(), np.isin(ends_b, cuts, assume_unique=True).tolist()
        # A's tokens of a group, then B's
        order = np.argsort(np.concatenate([2 * np.searchsorted(cuts, ends_a), 2 * np.searchsorted(cuts, ends_b) + 1]), kind="stable")
        words = [(self.end_a if e else self.inner)[i] for i, e in zip(a.tolist(), last_a)] + [(self.end_b if e else self.inner)[i] for i, e in zip(b.tolist(), last_b)]
        words = [words[k] for k in order.tolist()]
        tokens = (n_a + n_b).cumsum().tolist()
        at, done = 0, 0
        for c, n, link, token in zip(chunks, n_a.tolist(), links.tolist(), tokens):
            yield c, (pairs[8 * at:8 * link], n, b"".join(words[done:token])[:-1])
            at, done = link, token

    def texts(self, texts: list[str]) -> list[list[tuple]]:
        """The alignments of each text's chunks in order; empty without tokens."""
        parts = []
        for t in texts:
            odd = not t or "\0" in t or t[0].isspace() or t[-1].isspace() or ODD.search(t)
            parts.append(([" " + t] if t else []) if odd else [" " + c for c in t.split(" ")])
        met = set().union(*parts)
        own = self._chunks([c for c in met if c not in self.known])
        if len(self.known) + len(own) <= KEPT:
            self.known.update({c: v for c, v in own.items() if len(c) < 64})
        own |= {c: self.known[c] for c in met if c not in own}
        out = []
        for t, p in zip(texts, parts):
            found = [own[c] for c in p]
            if len(p) > 1 and None in found:  # the whole text decides
                found = [self._chunks([" " + t])[" " + t]]
            out.append([] if None in found else found)
        return out


@lru_cache(maxsize=1)
def aligner(file_a: str, file_b: str) -> Aligner:
    return Aligner(file_a, file_b)


# ---------------------------------------------------------------- records and runs
def _run(keys: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """One zstd run: pairs as differences, with their number of documents, then
    documents and times record by record."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    pairs, counts = keys[first], np.diff(first, append=len(keys))
    head = struct.pack("<QQ", len(pairs), len(keys))
    body = head + np.diff(pairs, prepend=0).astype("<u8").tobytes() + counts.astype("<u2").tobytes() + docs.astype("<u2").tobytes() + times.astype("<u4").tobytes()
    return zstandard.compress(body, 3)


def _pairs_of(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and their numbers of documents; the rest of the run stays packed."""
    n = struct.unpack("<QQ", (raw := zstandard.decompress(run))[:16])[0]
    return np.frombuffer(raw, "<u8", n, 16).astype(np.int64).cumsum(), np.frombuffer(raw, "<u2", n, 16 + 8 * n).astype(np.int64)


def _records_of(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.decompress(run)
    n, m = struct.unpack("<QQ", raw[:16])
    at = 16 + 10 * n
    return (np.frombuffer(raw, "<u8", n, 16).astype(np.int64).cumsum(), np.frombuffer(raw, "<u2", n, 16 + 8 * n).astype(np.int64),
            np.frombuffer(raw, "<u2", m, at).astype(np.int64), np.frombuffer(raw, "<u4", m, at + 2 * m).astype(np.int64))


def _runs(pairs: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(radix, records, run) of a block, given each document's linked pairs."""
    keys = np.frombuffer(b"".join(pairs), "<i8")
    docs = np.repeat(np.arange(len(pairs)), [len(p) // 8 for p in pairs])
    # one long to sort by: radix, A id, B id, document
    a = keys >> SHIFT
    order = np.sort((a % RADIX << 52) | (a // RADIX << 32) | ((keys & 0xFFFFFFFF) << 11) | docs)
    first = np.flatnonzero(np.diff(order, prepend=-1))
    own = order[first]
    times, docs, radix = np.diff(first, append=len(order)), own & (1 << 11) - 1, own >> 52
    keys = ((own >> 32 & (1 << 20) - 1) * RADIX + radix) << SHIFT | own >> 11 & (1 << 21) - 1
    edges = np.searchsorted(radix, np.arange(RADIX + 1))
    for r in range(RADIX):
        lo, hi = int(edges[r]), int(edges[r + 1])
        if hi > lo:
            yield r, hi - lo, _run(keys[lo:hi], docs[lo:hi], times[lo:hi])


DIGESTS = "block long, place int, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, radix int, records long, run binary"


def _mapped(docs: DataFrame, id_col: str, text_col: str, side_a: str, side_b: str) -> DataFrame:
    """Digest rows (``radix`` null) and run rows (``place`` null) of all blocks."""
    own = keyed_texts(docs, id_col, text_col).withColumn("part", F.spark_partition_id())
    schema = DIGESTS.format(id=own.schema["id"].dataType.simpleString())

    def block_of(number: int, ids: list, texts: list[str]) -> Iterator[dict]:
        pairs = []
        for place, (i, parts) in enumerate(zip(ids, aligner(side_a, side_b).texts(texts))):
            pairs.append(b"".join([p[0] for p in parts]))
            groups, n_a, n_links = b";".join([p[2] for p in parts]), sum([p[1] for p in parts]), len(pairs[-1]) // 8
            n_groups = groups.count(b"|")  # a group of x and y tokens has x + y - 1 links
            yield {"block": number, "place": place, "id": i, "n_a": n_a, "n_b": n_links + n_groups - n_a, "n_groups": n_groups,
                   "n_links": n_links, "groups_sha256": hashlib.sha256(groups).hexdigest() if parts else ""}
        for radix, records, run in _runs(pairs):
            yield {"block": number, "radix": radix, "records": records, "run": run}

    def run(batches):
        number, arrow = 0, None

        def batch_of(rows):
            return pa.RecordBatch.from_pydict({f.name: [r.get(f.name) for r in rows] for f in arrow}, schema=arrow)

        for batch in batches:
            arrow = arrow or pa.schema([("block", pa.int64()), ("place", pa.int32()), ("id", batch.schema.field("id").type), ("n_a", pa.int64()),
                                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                                        ("radix", pa.int32()), ("records", pa.int64()), ("run", pa.binary())])
            part = batch.column(2)[0].as_py() if len(batch) else 0
            ids, texts, size = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py() or ""
                if ids and (len(ids) == BLOCK_DOCS or size + len(t) > BLOCK_CHARS):
                    yield batch_of(list(block_of(part << 32 | number, ids, texts)))
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(i)
                texts.append(t)
                size += len(t)
            if ids:
                yield batch_of(list(block_of(part << 32 | number, ids, texts)))
                number += 1

    return own.mapInArrow(run, schema)


# ---------------------------------------------------------------- counting
def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted runs ``(pairs, counts)``: sorted pieces with summed
    counts, no pair in two pieces.

    The heap orders the runs by the last pair of their next ``STEP`` pairs.  All
    pairs up to the smallest of these are in the open steps, so they are final.
    """
    at = [0] * len(runs)
    heads = [(int(p[min(STEP, len(p)) - 1]), k) for k, (p, _) in enumerate(runs) if len(p)]
    heapq.heapify(heads)
    while heads:
        limit = heads[0][0]
        taken = []
        for _, k in heads:
            pairs, counts = runs[k]
            end = at[k] + int(np.searchsorted(pairs[at[k]:at[k] + STEP], limit, side="right"))
            if end > at[k]:
                taken.append((pairs[at[k]:end], counts[at[k]:end]))
                at[k] = end
        while heads and heads[0][0] <= limit:
            _, k = heapq.heappop(heads)
            if at[k] < len(runs[k][0]):
                heapq.heappush(heads, (int(runs[k][0][min(at[k] + STEP, len(runs[k][0])) - 1]), k))
        pairs, place = np.unique(np.concatenate([p for p, _ in taken]), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, place, np.concatenate([c for _, c in taken]))
        yield pairs, total


def _counted(runs: DataFrame) -> DataFrame:
    """``radix, pair, n``: the counts of each group of runs."""

    def count(key, table):
        out = list(merged([_pairs_of(r.as_py()) for r in table.column("run")]))
        pairs, n = (np.concatenate(c) for c in zip(*out))
        return pa.table({"radix": np.full(len(pairs), key[0].as_py(), np.int32), "pair": pairs, "n": n})

    return runs.select("radix", "part", "run").groupBy("radix", "part").applyInArrow(count, "radix int, pair long, n long")


def _slices(counts: DataFrame) -> DataFrame:
    """One row for each radix: its pairs in order, their counts, and which are the highest of their A id."""

    def side_major(key, table):
        pairs, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.diff(pairs >> SHIFT, prepend=-1))
        top = np.repeat(np.maximum.reduceat(n, first), np.diff(first, append=len(n)))
        pack = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "pairs": pack(pairs, "<i8"), "counts": pack(n, "<i8"), "best": pack(n == top, "u1")})

    return counts.groupBy("radix").applyInArrow(side_major, "radix int, pairs binary, counts binary, best binary")


def _contributions(runs: DataFrame, slices: DataFrame, groups: DataFrame) -> DataFrame:
    """``block, places, n_best, count_sum``: what each run returns to its block."""
    schema = "block long, places array<int>, n_best array<bigint>, count_sum array<bigint>"

    def give(key, own, counts):
        pairs, n, best = (np.frombuffer(counts.column(c)[0].as_py(), k) for c, k in (("pairs", "<i8"), ("counts", "<i8"), ("best", "u1")))
        out = {"block": own.column("block").to_pylist(), "places": [], "n_best": [], "count_sum": []}
        for r in own.column("run"):
            have, per, docs, times = _records_of(r.as_py())
            at = np.repeat(np.searchsorted(pairs, have), per)
            places, to = np.unique(docs, return_inverse=True)
            for name, value in (("n_best", best[at] * times), ("count_sum", n[at] * times)):
                total = np.zeros(len(places), np.int64)
                np.add.at(total, to, value)
                out[name].append(total)
            out["places"].append(places.astype(np.int32))
        return pa.table({"block": pa.array(out["block"], pa.int64()), "places": pa.array(out["places"], pa.list_(pa.int32())),
                         "n_best": pa.array(out["n_best"], pa.list_(pa.int64())), "count_sum": pa.array(out["count_sum"], pa.list_(pa.int64()))})

    dealt = slices.join(groups, "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pairs", "counts", "best")
    left = runs.select("radix", "part", "block", "run").groupBy("radix", "part")
    return left.cogroup(dealt.groupBy("radix", "part")).applyInArrow(give, schema)


def _finished(digests: DataFrame, given: DataFrame) -> DataFrame:
    """Each block's digests with the sums of what came back."""
    columns = ["id", "n_a", "n_b", "n_groups", "n_links"]
    types = ", ".join(f"{c} {digests.schema[c].dataType.simpleString()}" for c in columns)

    def add(key, own, back):
        places = own.column("place").to_numpy()
        sums = {c: np.zeros(int(places.max()) + 1 if len(places) else 0, np.int64) for c in ("n_best", "count_sum")}
        for row in range(len(back)):
            at = back.column("places")[row].values.to_numpy()
            for c, total in sums.items():
                total[at] += back.column(c)[row].values.to_numpy()
        more = {c: total[places] for c, total in sums.items()}
        return pa.table({**{c: own.column(c) for c in columns}, **more, "groups_sha256": own.column("groups_sha256")})

    return digests.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(add, f"{types}, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", side_a: str = SIDE_A, side_b: str = SIDE_B,
          group_records: int = GROUP_RECORDS) -> DataFrame:
    """One row for each row of ``docs``: ``id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256``."""
    mapped = written(_mapped(docs, id_col, text_col, side_a, side_b))
    digests = mapped.where(F.col("radix").isNull()).select("block", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    rows = mapped.where(F.col("radix").isNotNull()).select("block", "radix", "records", "run")
    # groups of a radix by its number of records: RADIX rows
    groups = rows.groupBy("radix").agg(F.ceil(F.sum("records") / group_records).cast("int").alias("parts"))
    parts = F.lit(1)
    for r in groups.collect():
        parts = F.when(F.col("radix") == r["radix"], F.lit(r["parts"])).otherwise(parts)
    runs = rows.select("block", "radix", F.pmod(F.xxhash64("block"), parts).cast("int").alias("part"), "run")
    counts = written(_counted(runs).groupBy("radix", "pair").agg(F.sum("n").alias("n")))
    given = _contributions(runs, _slices(counts), groups)
    return _finished(digests, given)


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", side_a: str = SIDE_A, side_b: str = SIDE_B) -> DataFrame:
    """``a, b, n``: in how many documents each pair of ids is linked."""
    mapped = written(_mapped(docs, id_col, text_col, side_a, side_b))
    runs = mapped.where(F.col("radix").isNotNull()).select("block", "radix", F.pmod(F.xxhash64("block"), F.lit(64)).cast("int").alias("part"), "run")
    n = _counted(runs).groupBy("pair").agg(F.sum("n").alias("n"))
    return n.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n")


def q_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
