"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``n`` consecutive words (an item of fewer
words, but not none, is one window).  Every window is a set of shingles, and a
document contains the window only if it contains the window's rarest shingle.
So, shingles being ordered by their count over all documents, a prefix of one
shingle is enough for containment:

1. count the items' shingles over all documents (map-side sums, one row for
   each item shingle and task);
2. each window keeps its rarest shingle and that shingle's place in it; windows
   with a shingle that no document has are dropped, as they can't occur;
3. documents are joined to the prefix shingles.  A match fixes the window's
   start (positional bound) and must leave room for its words within the text
   (length bound); what remains is verified word by word.

Documents never move.  The items are sent to the tasks in slices of at most
``slice_bytes`` of text, which is checked before; a larger benchmark takes
several passes, with the findings carried in the rows between them.

Words: A-Z lower-cased, then runs of ASCII letters, digits and non-ASCII
characters.  Null or empty texts have no words and no hits; items without words
are ignored; repeated rows and items are judged one by one (an item id counts
once for each document); a null item id is reported as ``null``; an empty
benchmark or document table gives no hits or no rows.  Other columns of either
table are not read.
"""
from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import wordgrid as G
from tessera.llm.common import keyed_texts, written

SHINGLE = 3
SEP = G.separators("alnum")
FOUND = "array<struct<start:int,end:int>>"


def _item_windows(texts: list[bytes], n: int):
    """Word hashes of all items, and (item, first word, words) of each window."""
    g = G.text_grid(texts, SEP, lower=True)
    rows = []
    for d in range(g.n):
        lo, hi = int(g.ptr[d]), int(g.ptr[d + 1])
        if hi > lo:
            size = min(n, hi - lo)
            rows += [(d, at, size) for at in range(lo, hi - size + 1)]
    return g, g.hashes(), np.array(rows, np.int64).reshape(-1, 3)


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    return hashes if size == 1 else G.window_hashes(hashes, size)


def _item_shingles(texts: list[bytes], n: int) -> dict[int, np.ndarray]:
    """Shingle size -> the distinct shingles of the windows that use that size."""
    _, hashes, rows = _item_windows(texts, n)
    out = defaultdict(list)
    for _, at, size in rows:
        q = min(SHINGLE, int(size))
        out[q].append(G.window_hashes(hashes[at:at + size], q) if q > 1 else hashes[at:at + size])
    return {q: np.unique(np.concatenate(v)) for q, v in out.items()}


class _Member:
    """Membership in a sorted array of hashes, behind a table of low bits."""

    def __init__(self, values: np.ndarray):
        self.values, self.seen = values, np.zeros(1 << 18, bool)
        self.seen[self.bits(values)] = True

    @staticmethod
    def bits(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << 18) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a member, and which one."""
        at = np.flatnonzero(self.seen[self.bits(h)])
        which = np.searchsorted(self.values, h[at])
        ok = which < len(self.values)
        ok[ok] = self.values[which[ok]] == h[at][ok]
        return at[ok], which[ok]


def _count_shingles(docs: DataFrame, sent, n: int) -> dict[int, int]:
    """How often each item shingle occurs in the documents."""

    def count(batches):
        tables = {q: _Member(v) for q, v in _item_shingles(sent.value, n).items()}
        sums = {q: np.zeros(len(t.values), np.int64) for q, t in tables.items()}
        for batch in batches:
            for g in G.grids(batch.column(0), SEP, lower=True):
                hashes = g.hashes()
                for q, t in tables.items():
                    h = _shingles(hashes, q)
                    h = h[G.window_ok(g.ptr, len(hashes), q)]
                    sums[q] += np.bincount(t.find(h)[1], minlength=len(t.values))
        for q, t in tables.items():
            some = np.flatnonzero(sums[q])
            yield pa.RecordBatch.from_arrays([pa.array(t.values[some].view(np.int64)), pa.array(sums[q][some])], ["shingle", "n"])

    parts = docs.select("text").mapInArrow(count, "shingle long, n long")
    total = parts.groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r[0]: r[1] for r in total.collect()}  # at most the slice's shingles


def _index(texts: list[bytes], n: int, counts: dict[int, int]):
    """Prefix index: for each shingle size, its rare shingles and their windows."""
    g, hashes, rows = _item_windows(texts, n)
    words = [g.word(i) for i in range(len(g.starts))]
    by: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    known: dict[tuple, tuple] = {}
    for item, at, size in rows.tolist():
        content = tuple(words[at:at + size])
        if content not in known:
            q = min(SHINGLE, size)
            own = _shingles(hashes[at:at + size], q).view(np.int64).tolist()
            count, shingle, place = min((counts.get(s, 0), s, k) for k, s in enumerate(own))
            known[content] = items = (set(),)
            if count:
                by[q][shingle].append((place, content, items[0]))
        known[content][0].add(item)
    out = {}
    for q, table in by.items():
        keys = np.array(sorted(table), np.int64).view(np.uint64)
        keys.sort()
        out[q] = (_Member(keys), [table[k] for k in keys.view(np.int64).tolist()])
    return out


def _scan(docs: DataFrame, sent, ids: list[str], n: int, counts: dict[int, int]) -> DataFrame:
    """Findings of one slice added to ``id, text, n_words, spans, items`` and whatever follows."""
    kept = docs.sparkSession.sparkContext.broadcast(counts)
    schema = docs.schema

    def scan(batches):
        index = _index(sent.value, n, kept.value)
        for batch in batches:
            spans, items, sizes = [], [], []
            old_spans, old_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for g in G.grids(batch.column(1), SEP, lower=True):
                hashes, doc = g.hashes(), g.doc_of_word()
                found: dict[int, tuple[set, set]] = defaultdict(lambda: (set(), set()))
                for q, (member, lists) in index.items():
                    h = _shingles(hashes, q)
                    ok = G.window_ok(g.ptr, len(hashes), q)
                    for at, which in zip(*map(np.ndarray.tolist, member.find(h))):
                        if not ok[at]:
                            continue
                        d = int(doc[at])
                        lo, hi = int(g.ptr[d]), int(g.ptr[d + 1])
                        for place, content, of in lists[which]:
                            start = at - place
                            end = start + len(content)
                            if start >= lo and end <= hi and all(g.word(start + k) == w for k, w in enumerate(content)):
                                found[d][0].add((start - lo, end - lo))
                                found[d][1].update(of)
                for d in range(g.n):
                    s, i = found.get(d, ((), ()))
                    r = g.first + d
                    spans.append(_merged([*s, *((x["start"], x["end"]) for x in old_spans[r])]))
                    items.append(sorted({*(ids[k] for k in i), *old_items[r]}))
                    sizes.append(int(g.ptr[d + 1] - g.ptr[d]))
            rows = [[{"start": a, "end": b} for a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string())), *batch.columns[5:]], batch.schema.names)

    return docs.mapInArrow(scan, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _find(state: DataFrame, items: DataFrame, item_col: str, item_text_col: str, n: int, slice_bytes: int) -> DataFrame:
    spark = state.sparkSession
    own = keyed_texts(items, item_col, item_text_col)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    slices = max(1, -(-int(own.agg(F.sum(size)).first()[0] or 0) // slice_bytes))
    of = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(slices))
    for k in range(slices):
        part = own.where(of == k).collect()  # one slice: about slice_bytes of text
        sent = spark.sparkContext.broadcast([(r[1] or "").encode() for r in part])
        ids = ["null" if r[0] is None else str(r[0]) for r in part]
        counts = _count_shingles(state, sent, n)
        state = _scan(state, sent, ids, n, counts)
        if k < slices - 1:
            state = written(state)
    return state


def _empty():
    return [F.lit(0).cast("long").alias("n_words"), F.array().cast(FOUND).alias("spans"), F.array().cast("array<string>").alias("items")]


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", n: int = 10,
               slice_bytes: int = 8 << 20) -> DataFrame:
    """For each row of ``docs``: ``id, text, n_words, spans, items``.

    ``spans`` are the merged word ranges (end exclusive) that lie inside an
    occurrence of a window; ``items`` the ids, as sorted strings, of the items
    that have an occurring window.
    """
    state = keyed_texts(docs, id_col, text_col).select("id", "text", *_empty())
    return _find(state, items, item_col, item_text_col, n, slice_bytes)


def clean_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", n: int = 10, slice_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of any item."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    state = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *_empty(), row)
    return _find(state, items, item_col, item_text_col, n, slice_bytes).where(F.size("spans") == 0).select("row.*")


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))


def q_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_items(docs, items).select(
        F.col("id").alias("doc_id"), "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
docwin AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
occ AS (SELECT doc_id, d.k, i, item_id FROM docwin d JOIN win USING (s) WHERE d.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS l
        FROM occ GROUP BY doc_id)
SELECT dw.doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(hit.n, 0) AS bigint) AS n_hit,
       cast(coalesce(its.n, 0) AS bigint) AS n_items, sha256(coalesce(its.l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
"""
