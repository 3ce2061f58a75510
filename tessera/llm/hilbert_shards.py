"""Shards as runs of a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``2**bits`` levels (text size on a log2 scale,
categories by hash).  The cells of that grid are put in the order of the curve,
rows in the order of their cells, and the row order is cut into runs whose
counts differ by at most one (law ``rows``).  Neighbouring cells share levels,
so each shard covers a narrow range of every dimension and ``manifest`` lets a
reader skip shards on any of them.

Only DataFrame functions run.  Rows are never sorted as a whole: a cell's rows
are numbered in hash buckets (``exact_ranks``), and the cells' counts, at most
``2 ** (bits * dimensions)`` of them, give each cell's first number.  A cell or
source that holds a third of the rows is spread over all its buckets.

A null text has size 1 and the checksum of the empty text; null metadata is a
category of its own; repeated rows each get a place; an empty table gives no
rows; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, exact_ranks, written

BITS = 4


def size_level(size: Column, bits: int = BITS, smallest: int = 4) -> Column:
    """log2 of the size, from ``2**smallest`` on, in ``2**bits`` levels."""
    level = F.floor(F.log2(size.cast("double"))) - smallest
    return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), level)).cast("int")


def category_level(col: Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(1 << bits)).cast("int")


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Place of a grid cell on the Hilbert curve: the levels are rotated and
    reflected from the highest bit down, Gray-coded, and their bits interleaved."""
    n = len(levels)
    x = F.array(*[lv.cast("int") for lv in levels])

    def flip(x, mask, at):
        """Exclusive-or of ``mask`` into the elements for which ``at`` holds."""
        return F.transform(x, lambda v, j: F.when(at(j), v.bitwiseXOR(mask)).otherwise(v))

    def turn(x, q, i):
        p = q - F.lit(1)
        own, first = F.element_at(x, i + 1), F.element_at(x, F.lit(1))
        swap = first.bitwiseXOR(own).bitwiseAND(p)
        return F.when(own.bitwiseAND(q) != 0, flip(x, p, lambda j: j == 0)).otherwise(
            flip(x, swap, lambda j: ((j == 0) | (j == i)) & (i != 0)))

    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])
    x = F.aggregate(steps, x, lambda acc, s: turn(acc, s["q"], s["i"]))
    # Gray code: element i is the exclusive-or of all elements up to i
    x = F.transform(x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))
    tops = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    x = F.transform(x, lambda v: v.bitwiseXOR(F.aggregate(
        tops, F.lit(0), lambda t, q: F.when(F.element_at(x, n).bitwiseAND(q) != 0, t.bitwiseXOR(q - F.lit(1))).otherwise(t))))
    bit = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(bit, F.lit(0).cast("long"),
                       lambda acc, s: acc * 2 + F.when(F.element_at(x, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0))


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   categories: tuple[str, ...] = ("source", "lang"), bits: int = BITS) -> DataFrame:
    """``id, size, text_crc32, level_0.., hilbert, rank, shard, slot`` of each row.

    Level 0 is that of the size; the others follow ``categories``.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    names = [f"level_{k}" for k in range(len(categories) + 1)]
    levels = [size_level(size, bits), *(category_level(F.col(f"`{c}`"), bits) for c in categories)]
    rows = written(docs.select(F.col(f"`{id_col}`").alias("id"), size.alias("size"), F.crc32(text).alias("text_crc32"),
                               *[lv.alias(n) for lv, n in zip(levels, names)]))
    curve = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    cells = (rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("hilbert", hilbert_index([F.col(n) for n in names], bits))
             .withColumn("_start", F.coalesce(F.sum("_n").over(curve), F.lit(0)))
             .withColumn("_total", F.sum("_n").over(Window.partitionBy()))
             .select(*[F.col(n).alias(f"_{n}") for n in names], "hilbert", "_start", "_total"))
    ranked = exact_ranks(rows, names, ["id", "text_crc32", "size"])
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"_{n}"))
    placed = ranked.join(F.broadcast(cells), same).withColumn("rank", F.col("rank") + F.col("_start"))  # at most 2 ** (bits * dimensions) cells
    shard = F.expr(f"cast((rank * {int(shards)}) div _total as int)")
    first = F.expr(f"(shard * _total + {int(shards) - 1}) div {int(shards)}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .select("id", "size", "text_crc32", *names, "hilbert", "rank", "shard", "slot"))


def manifest(sharded: DataFrame) -> DataFrame:
    """Rows, bytes and the range of every dimension for each shard."""
    names = [c for c in sharded.columns if c.startswith("level_")]
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        *[f(n).alias(f"{n}_{k}") for n in names for k, f in (("min", F.min), ("max", F.max))])


def q_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    return hilbert_shards(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")
