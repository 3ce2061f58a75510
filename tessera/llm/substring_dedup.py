"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``size`` consecutive words of one document.  Its minimiser is the
least hash among its runs of ``MINIMISER`` words; consecutive windows that share
one form a super-k-mer and travel as one packed string of words to the
minimiser's bucket.  Equal windows have equal minimisers, so they meet there,
where sorting finds equal windows exactly, by their words.  A window stays if no
equal one starts earlier, and words of the others are removed.

What need not travel stays behind:

* minimisers are counted first.  One that occurs once cannot stand for a
  repeated window; the repeated ones are marked in a table of ``2 ** BITS`` bits
  (16 MB whatever the input; a fuller table prunes less and loses nothing);
* a task settles equal super-k-mers of a batch itself: all but the earliest are
  repeats, and only that one travels.  Copies of one text thus send a string for
  each batch, not for each copy;
* minimisers holding over 1 / ``HOT`` of all super-k-mers (``HOT`` at most) don't
  form buckets of their own: each of their windows travels alone, to a bucket
  of its own hash.

"Earlier": smaller id (nulls first), and within one document the smaller start.
Rows with the same id and text are one document and get the same result; rows
with the same id and other text are ordered by the text's hash.  Words are runs
of anything but x20 and x09-x0D, unchanged; null, empty and blank texts have
none.  An empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import wordgrid as G
from tessera.llm.common import documents, keyed_texts, written

SEP = G.separators("space")
MINIMISER, BITS, HOT = 6, 27, 2000
CHUNK = 20_000


def _super_kmers(g: G.Grid, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimiser, text) of each super-k-mer of a grid."""
    m = min(MINIMISER, size)
    hashes = g.hashes()
    starts = np.flatnonzero(G.window_ok(g.ptr, len(hashes), size))
    if len(starts) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    runs = G.window_hashes(hashes, m)
    view = np.lib.stride_tricks.sliding_window_view(runs, size - m + 1)
    place = starts + view[starts].argmin(axis=1) if len(starts) < len(view) else starts + view.argmin(axis=1)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    return starts[at], count, runs[place[at]], np.searchsorted(g.ptr, starts[at], side="right") - 1


def _minimiser_counts(own: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for g in G.grids(batch.column(0), SEP):
                keys, n = np.unique(_super_kmers(g, size)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["mini", "n"])

    return own.select("text").mapInArrow(run, "mini long, n long").groupBy("mini").agg(F.sum("n").alias("n")).where("n > 1")


def _bit(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _bit_table(repeated: DataFrame) -> np.ndarray:
    """The repeated minimisers as a table of a fixed number of bits."""
    bit = F.col("mini").bitwiseAND(F.lit((1 << BITS) - 1))
    parts = repeated.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767))).alias("bits")).collect()  # 2 ** (BITS - 15) rows at most
    table = np.zeros(1 << (BITS - 3), np.uint8)
    for r in parts:
        table[r["part"] << 12:(r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return table


ROW = ["key", "packed", "set", "id", "h", "start", "n"]


def _travelling(own: DataFrame, size: int, table: np.ndarray, hot: set[int], id_type: str) -> DataFrame:
    """Rows that go to buckets, and (without a packed string) what is settled."""
    sent = own.sparkSession.sparkContext.broadcast((table, hot))

    def run(batches):
        bits, often = sent.value
        for batch in batches:
            owner = list(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))))
            first: dict[tuple[int, bytes], tuple] = {}
            settled: list[tuple] = []
            for g in G.grids(batch.column(0), SEP):
                start, count, mini, doc = _super_kmers(g, size)
                b = _bit(mini)
                at = np.flatnonzero(bits[b >> 3] >> (b & 7).astype(np.uint8) & 1)
                for s, n, key, d in zip(start[at].tolist(), count[at].tolist(), mini[at].view(np.int64).tolist(), doc[at].tolist()):
                    words = g.buf[g.starts[s]:g.ends[s + n + size - 2]].tobytes().split()
                    lo = s - int(g.ptr[d])
                    if key in often:
                        parts = [(None, b" ".join(words[j:j + size]), lo + j, 1) for j in range(n)]
                    else:
                        parts = [(key, b" ".join(words), lo, n)]
                    for k, packed, where, many in parts:
                        place = (*owner[g.first + d], where, many)
                        old = first.setdefault((k, packed), place)
                        if place[:4] < old[:4]:
                            first[k, packed] = place
                            settled.append(old)
                        elif place[:4] > old[:4]:
                            settled.append(place)
            rows = [(_bucket(packed) if k is None else k, packed, *p) for (k, packed), p in first.items()]
            rows += [(_bucket(repr(p[:3]).encode()), None, *p) for p in settled]
            for k in range(0, len(rows), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + CHUNK]), types)], ROW)

    id_arrow = pa.string() if id_type == "string" else pa.int64()
    types = [pa.int64(), pa.binary(), pa.bool_(), id_arrow, pa.int64(), pa.int32(), pa.int32()]
    return own.select("text", "set", "id", "h").mapInArrow(
        run, f"key long, packed binary, set boolean, id {id_type}, h long, start int, n int")


def _bucket(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _later_windows(rows: list[tuple], seen: dict[bytes, tuple], size: int) -> Iterator[tuple[tuple, list[int]]]:
    """For rows (packed, place, n) in document order: the windows of each that
    start earlier elsewhere.  ``seen`` has the windows of the bucket's earlier rows."""
    whole: dict[bytes, tuple] = {}
    windows, later = [], [[] for _ in rows]
    for r, (packed, place, n) in enumerate(rows):
        if packed in whole:
            if place != whole[packed]:
                later[r] = list(range(n))
            continue
        whole[packed] = place
        words = packed.split(b" ")
        windows += [(b" ".join(words[j:j + size]), r, j) for j in range(n)]
    windows.sort()
    last, first = None, None
    for w, r, j in windows:
        place = (*rows[r][1][:3], rows[r][1][3] + j)
        if w != last:
            last, first = w, seen.setdefault(w, place)
        if place != first:
            later[r].append(j)
    return zip(rows, later)


def _spans(starts: list[int], lo: int, size: int) -> list[tuple[int, int]]:
    out = []
    for j in sorted(starts):
        if out and lo + j <= out[-1][1]:
            out[-1] = (out[-1][0], lo + j + size)
        else:
            out.append((lo + j, lo + j + size))
    return out


def _repeats(bucketed: DataFrame, size: int, id_type: str) -> DataFrame:
    """``set, id, h, lo, hi``: word ranges to remove.  Input sorted by key and document order."""

    def run(batches):
        out: list[tuple] = []
        key, rows, seen, many = None, [], {}, False

        def settle(final):
            nonlocal rows, seen, many
            if len(rows) > 1 or seen:
                for (_, place, _n), later in _later_windows(rows, seen, size):
                    out.extend((*place[:3], a, b) for a, b in _spans(later, place[3], size))
            rows = []
            if final:
                seen = {}

        for batch in batches:
            for k, packed, s, i, h, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                if packed is None:
                    out.append((s, i, h, start, start + n + size - 1))
                    continue
                if k != key:
                    settle(True)
                    key = k
                elif len(rows) >= CHUNK:
                    settle(False)
                rows.append((packed, (s, i, h, start), n))
            if len(out) >= CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        settle(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["set", "id", "h", "lo", "hi"]
    types = [pa.bool_(), pa.string() if id_type == "string" else pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return bucketed.mapInArrow(run, f"set boolean, id {id_type}, h long, lo int, hi int")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 20) -> DataFrame:
    """``id, n_words, n_removed, kept`` of each row; ``kept`` joins what stays by one space."""
    id_type = "string" if docs.schema[id_col].dataType.simpleString() == "string" else "bigint"
    own = keyed_texts(docs, id_col, text_col).select(
        F.col("id").isNotNull().alias("set"), F.coalesce(F.col("id").cast(id_type), F.lit(0).cast(id_type)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    repeated = written(_minimiser_counts(own, size))
    total = repeated.agg(F.sum("n")).first()[0] or 0
    hot = {r[0] for r in repeated.where(F.col("n") > max(1000, total // HOT)).select("mini").collect()}  # under HOT rows
    moving = _travelling(own, size, _bit_table(repeated), hot, id_type)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = _repeats(moving.repartition(parts, "key").sortWithinPartitions("key", "set", "id", "h", "start"), size, id_type)
    by_doc = spans.groupBy("set", "id", "h").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # ranges of one document
    rows = own.join(by_doc, ["set", "id", "h"], "left").select(F.when(F.col("set"), F.col("id")).alias("id"), "text", "spans")

    def cut(batches):
        for batch in batches:
            total, gone, kept = [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2).to_pylist()):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                total.append(len(words))
                for r in sorted(ranges or (), key=lambda r: (-r["lo"], -r["hi"])):
                    words[r["lo"]:r["hi"]] = [None] * (r["hi"] - r["lo"])
                stay = [w for w in words if w is not None]
                gone.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             ["id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(cut, f"id {id_type}, n_words long, n_removed long, kept string")


def q_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeats(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id),
words AS (SELECT w.doc_id, w, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM w) w),
hit AS (SELECT DISTINCT doc_id, unnest(g) AS p FROM gone),
kept AS (SELECT words.doc_id, string_agg(w[words.p], ' ' ORDER BY words.p) AS k, count(*) AS n
         FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id AND words.p = hit.p WHERE hit.p IS NULL GROUP BY words.doc_id)
SELECT w.doc_id, cast(len(w.w) AS bigint) AS n_words, cast(len(w.w) - coalesce(kept.n, 0) AS bigint) AS n_removed,
       sha256(coalesce(kept.k, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
