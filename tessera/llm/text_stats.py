"""Statistics of whole texts, for the quality operators.

Counts are exact: equal words, lines and windows are found by 64-bit hashes
within one text.  A null text counts as empty; all statistics of a text without
words are 0.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import wordgrid as G
from tessera.llm.common import crc_fold, hash_sample, written

SEP = G.separators("space")
WINDOW = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbols_a_word", "dup_line_share", "repeat_share", "chars_a_word", "upper_share", "digit_share", "mark_share",
          "distinct_share", "top_word_share", "echo_share", "words_a_line", "caps_word_share", "exclaim_share"]
ALL = COUNTS + RATIOS


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[cuts])


def _of_text(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that are equal only within one text."""
    return G.mixed(keys + doc.astype(np.uint64) * np.uint64(G.MULTIPLIER))


def _range(lo: int, hi: int) -> np.ndarray:
    return np.isin(np.arange(256), np.arange(lo, hi + 1))


UPPER, LOWERS, DIGIT = _range(65, 90), _range(97, 122), _range(48, 57)
MARK = _range(33, 47) | _range(58, 64) | _range(91, 96) | _range(123, 126)


def stats(g: G.Grid) -> dict[str, np.ndarray]:
    """Arrays of each statistic, one value for each text of the grid."""
    n, buf, doc = g.n, g.buf, g.doc_of_word()
    words = np.diff(g.ptr)
    hashes = g.hashes()
    out = {"n_words": words}
    inside = ~SEP[buf]
    out["word_chars"] = _sums(inside & ((buf & 0xC0) != 0x80), g.offs)
    out["n_symbols"] = _sums(SYMBOLS[buf], g.offs)

    # lines: cut at \n and at the ends of texts
    newline = np.flatnonzero(buf == 10)
    starts = np.union1d(g.offs[:-1], newline + 1)
    starts = starts[starts < len(buf)]
    ends = np.minimum(np.append(starts[1:], len(buf)), len(buf))
    bare = ends - (buf[ends - 1] == 10) if len(starts) else ends
    line_doc = np.searchsorted(g.offs, starts, side="right") - 1
    first_word = np.searchsorted(g.starts, starts)
    has = np.searchsorted(g.starts, bare) > first_word
    keys = _of_text(G._range_hash(buf.astype(np.uint64) + np.uint64(1), starts[has], bare[has]), line_doc[has])
    lines = np.bincount(line_doc[has], minlength=n)
    _, first = np.unique(keys, return_index=True)
    out["n_dup_lines"] = lines - np.bincount(line_doc[has][first], minlength=n)

    windows = G.window_hashes(hashes, WINDOW)
    ok = np.flatnonzero(G.window_ok(g.ptr, len(hashes), WINDOW))
    _, back, times = np.unique(_of_text(windows[ok], doc[ok]), return_inverse=True, return_counts=True)
    again = ok[times[back] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    out["n_repeat_words"] = _sums(np.cumsum(cover[:-1]) > 0, g.ptr)

    keys = _of_text(hashes, doc)
    _, first, times = np.unique(keys, return_index=True, return_counts=True)
    distinct = np.bincount(doc[first], minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc[first], times)
    echo = np.zeros(len(keys), bool)
    echo[1:] = keys[1:] == keys[:-1]
    upper, lower = _sums(UPPER[buf], g.offs), _sums(LOWERS[buf], g.offs)
    at_word = lambda flags: np.add.reduceat(flags[: g.ends[-1]].astype(np.int32), g.starts) if len(g.starts) else np.zeros(0, int)
    caps = (at_word(UPPER[buf]) > 1) & (at_word(LOWERS[buf]) == 0)
    share = lambda a, b: a / np.maximum(b, 1)
    return out | {
        "symbols_a_word": share(out["n_symbols"], words), "dup_line_share": share(out["n_dup_lines"], lines),
        "repeat_share": share(out["n_repeat_words"], words), "chars_a_word": share(out["word_chars"], words),
        "upper_share": share(upper, upper + lower), "digit_share": share(_sums(DIGIT[buf], g.offs), out["word_chars"]),
        "mark_share": share(_sums(MARK[buf], g.offs), out["word_chars"]), "distinct_share": share(distinct, words),
        "top_word_share": share(top, words), "echo_share": share(_sums(echo, g.ptr), words), "words_a_line": share(words, lines),
        "caps_word_share": share(_sums(caps, g.ptr), words), "exclaim_share": share(_sums(buf == 33, g.offs), words)}


def with_stats(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``stats``, a struct of all statistics (a column of that name is replaced)."""
    at = df.columns.index(text_col)
    kept = [c for c in df.columns if c != "stats" and (keep_text or c != text_col)]
    fields = [f"`{c}`" for c in kept]
    types = ", ".join(f"{f} {df.schema[c].dataType.simpleString()}" for f, c in zip(fields, kept))
    struct = ", ".join([*(f"{c}:bigint" for c in COUNTS), *(f"{c}:double" for c in RATIOS)])

    def run(batches):
        for batch in batches:
            parts = [stats(g) for g in G.grids(batch.column(at), SEP)]
            cols = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0) for c in ALL]
            arrays = [pa.array(v.astype(np.int64) if c in COUNTS else v.astype(float)) for c, v in zip(ALL, cols)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.StructArray.from_arrays(arrays, ALL)], [*kept, "stats"])

    return df.mapInArrow(run, f"{types}, stats struct<{struct}>")


def labelled_sample(spark: SparkSession, docs: DataFrame, sf_dir: str, label: str = "quality", folds: int = 5, held_out: int = 0,
                    per_class: int = 6000) -> DataFrame:
    """``stats, label`` of a bounded sample of labelled rows outside the held-out fold.

    The sample has about ``per_class`` rows of each class, chosen by the hash of
    the id, so its ids may be broadcast whatever the input size.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(label).cast("int").alias("label"))
    usable = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold("doc_id", folds) != held_out))
    chosen = hash_sample(usable, "doc_id", "label", per_class).distinct()
    own = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    rows = own.join(F.broadcast(chosen.withColumnRenamed("doc_id", "id")), "id").select("text", "label")  # about 2 * per_class ids
    return written(with_stats(rows, keep_text=False))
