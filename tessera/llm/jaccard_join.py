"""Exact Jaccard self-join of shingle sets, with set-relation skipping.

Texts with the same words are one node.  A node's set holds 64-bit hashes of
its distinct shingles.

* **Answer-level skipping, first.**  Texts whose smallest hash is equal meet in
  one stream, in order of size, each text moving once.  Each is compared with
  up to ``LEADERS`` sets kept from before; one that links to a leader shares its
  class, so whatever is linked to one of them is reached through any, and no
  pair within the class is compared again.  Groups that hold much of the corpus
  are dealt into parts, whose first sets meet once more.
* **Index-level skipping.**  All sets use one order of shingles: by a table of
  ``COUNTERS`` counts over the whole corpus (rare ones first), then by hash.  Two
  sets that reach the threshold share a shingle in their prefixes, so only
  prefixes are indexed.  Each shingle's list is ordered by set size and cut where
  neighbours' sizes are too far apart to link; lists within one class go.  In
  two rounds each entry is compared with the first of its list and with the
  ``NEAR`` entries before it in order of size, one pair of sets, the likeliest,
  for a pair of classes: sets that link with each other become one class by
  their neighbours, wherever in the list they stand.  What is still open is
  compared in blocks of ``BLOCK`` entries, by class: blocks of one class never
  meet, and pairs of blocks that the length or positional bound excludes are
  skipped.
* Known overlaps with a list's first set bound those of the other pairs:
  ``|x & y| <= min(|x & l|, |y & l|) + min(|x - l|, |y - l|)``.

A pair that remains must pass a parity signature of ``SIGNATURE`` bits (sets that
differ in ``d`` shingles differ in at most ``d`` bits) where it meets, before it
becomes a row.  Of the pairs left between two classes the likeliest is compared
first, and the others only if the classes stay apart, so whole sets move for few
pairs.

No link between classes is lost; classes are the connected components.  Tables
sent to tasks have a fixed size: the counts (4 MB), bits of the ids or hashes
that are wanted (2 MB each; when they fill, more texts move and none is lost)
and at most ``SHARES`` hot hashes.

Words: A-Z lower-cased, runs of anything but x20 and x09-x0D.  A text of fewer
words than a shingle is one shingle; null, empty and blank texts have an empty
set and are linked with nothing.  Repeated rows are copies of each other.  A
class with null ids only has a null ``component_id``; an empty table gives no
rows; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import wordgrid as G
from tessera.llm.common import bound_batches, documents, keyed_texts, written
from tessera.llm.components import components

SEP = G.separators("space")
BLOCK = 64
LEADERS, NEAR = 8, 3
COUNTERS, PART = 1 << 20, 1 << 14
BITS = 24
HOT, SHARES = 2000, 16384
SIGNATURE = 1024


def _nodes(texts: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, node, sorted distinct shingles) of every text that has words."""
    for g in G.grids(texts, SEP, lower=True):
        hashes = g.hashes()
        node = G._range_hash(hashes, g.ptr[:-1], g.ptr[1:]).view(np.int64)
        windows = G.window_hashes(hashes, words)
        for d in range(g.n):
            lo, hi = int(g.ptr[d]), int(g.ptr[d + 1])
            if hi - lo >= words:
                yield g.first + d, int(node[d]), np.unique(windows[lo:hi - words + 1])
            elif hi > lo:
                yield g.first + d, int(node[d]), node[d:d + 1].view(np.uint64)


def _signature(shingles: np.ndarray) -> np.ndarray:
    """How often each of ``SIGNATURE`` buckets is met, modulo 2, as longs."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (SIGNATURE - 1), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _with_nodes(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    """Add ``node`` and ``n_shingles`` (0 and a null node without words) to rows
    whose second column is the text."""
    node, size = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
    for row, key, s in _nodes(batch.column(1), words):
        node[row], size[row] = key, len(s)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, mask=size == 0), pa.array(size)],
                                      [*batch.schema.names, "node", "n_shingles"])


def text_nodes(own: DataFrame, words: int = 5) -> DataFrame:
    """``_with_nodes`` of all rows."""

    def run(batches):
        for batch in batches:
            yield _with_nodes(batch, words)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(run, f"{types}, node long, n_shingles long")


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) & (COUNTERS - 1)


def _scanned(own: DataFrame, words: int) -> DataFrame:
    """``id, node, n_shingles, least, sig`` of each row, ``least`` being its
    smallest shingle; and from each task its counts of shingles, in rows of
    ``part, counts`` with nothing else."""
    names = ["id", "node", "n_shingles", "least", "sig", "part", "counts"]

    def run(batches):
        counts, seen, kind = np.zeros(COUNTERS, np.uint32), set(), None
        for batch in batches:
            kind, n = batch.column(0).type, len(batch)
            node, size, least = (np.zeros(n, np.int64) for _ in range(3))
            sig = np.zeros((n, SIGNATURE // 64), np.int64)
            new, many = [], 0
            for row, key, s in _nodes(batch.column(1), words):
                node[row], size[row], least[row] = key, len(s), s[:1].view(np.int64)[0]
                sig[row] = _signature(s)
                if key not in seen:
                    seen.add(key)
                    new.append(_counter(s))
                    many += len(s)
                    if many > COUNTERS:
                        counts += np.bincount(np.concatenate(new), minlength=COUNTERS).astype(np.uint32)
                        new, many = [], 0
            if new:
                counts += np.bincount(np.concatenate(new), minlength=COUNTERS).astype(np.uint32)
            sigs = pa.ListArray.from_arrays(np.arange(0, sig.size + 1, SIGNATURE // 64, dtype=np.int32), sig.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, mask=size == 0), pa.array(size), pa.array(least, mask=size == 0), sigs,
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if seen:
            parts = range(COUNTERS // PART)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(parts), kind), *(pa.nulls(len(parts), pa.int64()) for _ in range(3)), pa.nulls(len(parts), pa.list_(pa.int64())),
                 pa.array(parts, pa.int32()), pa.array([counts[k * PART:(k + 1) * PART].tobytes() for k in parts])], names)

    id_type = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {id_type}, node long, n_shingles long, least long, sig array<bigint>, part int, counts binary")


def _counted(scan: DataFrame) -> np.ndarray:
    """The tasks' counts added up: in the tasks that read them, then by part."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.frombuffer(data, np.uint32)
                old = total.get(part)
                # saturates: only the order of the counts matters
                total[part] = new if old is None else np.minimum(old.astype(np.uint64) + new, 0xFFFFFFFF).astype(np.uint32)
        for part, c in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([c.tobytes()])], ["part", "counts"])

    types = "part int, counts binary"
    rows = scan.where("part is not null").select("part", "counts").mapInArrow(run, types).repartition("part").mapInArrow(run, types)
    table = np.zeros(COUNTERS, np.uint32)
    for r in rows.collect():  # COUNTERS / PART rows
        table[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.uint32)
    return table


def _bit_table(keys: DataFrame) -> np.ndarray:
    """The longs of the only column as a table of ``1 << BITS`` bits."""
    bit = F.col(keys.columns[0]).bitwiseAND(F.lit((1 << BITS) - 1))
    parts = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767))).alias("bits")).collect()  # 2 ** (BITS - 15) rows at most
    table = np.zeros(1 << (BITS - 3), np.uint8)
    for r in parts:
        table[r["part"] << 12:(r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return table


def _has_bit(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & ((1 << BITS) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _postings(own: DataFrame, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``token, node, size, pos`` for each prefix shingle; equal texts of a task once."""
    sent = own.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        often, seen = sent.value, set()
        for batch in batches:
            out, many = [], 0
            for _, node, s in _nodes(batch.column(0), words):
                if node in seen:
                    continue
                seen.add(node)
                n = len(s)
                keep = n - -(-percent * n // 100) + 1
                s = s[np.argsort(often[_counter(s)], kind="stable")[:keep]]
                out.append((s.view(np.int64), np.full(keep, node), np.full(keep, n, np.int32), np.arange(keep, dtype=np.int32)))
                many += keep
                if many > 1 << 16:
                    yield _batch(out)
                    out, many = [], 0
            if out:
                yield _batch(out)

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["token", "node", "size", "pos"])

    return own.select("text").mapInArrow(run, "token long, node long, size int, pos int")


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    return int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())


def _met(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Stream ``least, part, size, node, text`` group by group, in order of size.

    ``a, b, overlap, linked`` of each set ``b`` with the leaders ``a`` that it was
    compared with; and the first set of each part of a group dealt out, in rows
    of ``least, size, node, text``.
    """
    dealt = texts.repartition("least", "part").sortWithinPartitions("least", "part", "size", "node")
    names = ["a", "b", "overlap", "linked", "least", "size", "node", "text"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.string()]

    def run(batches):
        group, leaders, last = None, [], None
        for batch in batches:
            least, part, _, nodes = (c.to_pylist() for c in batch.columns[:4])
            out = []
            for row, node, s in _nodes(batch.column(4), words):
                if (least[row], part[row]) != group:
                    group, leaders, last = (least[row], part[row]), [], None
                    if part[row] >= 0:
                        out.append((None, None, None, None, least[row], len(s), node, batch.column(4)[row].as_py()))
                if node == last:
                    continue
                last = node
                for other, x in reversed(leaders):
                    if 100 * len(x) < percent * len(s):
                        continue
                    n = _overlap(x, s)
                    linked = 100 * n >= percent * (len(x) + len(s) - n)
                    out.append((other, node, n, linked, None, None, None, None))
                    if linked:
                        break
                else:
                    leaders = [*leaders[-(LEADERS - 1):], (node, s)] if LEADERS > 1 else [(node, s)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return dealt.mapInArrow(run, "a long, b long, overlap int, linked boolean, least long, size int, node long, text string")


def _first_answers(own: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b, overlap, linked``: sets of equal smallest shingle against leaders."""
    sizes = written(nodes.where("n_shingles > 0").groupBy("least", "node").agg(F.lit(1)).groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    most = max(HOT, total // SHARES)
    hot = {r["least"]: -(-r["n"] // most) for r in sizes.where(F.col("n") > most).collect()}  # SHARES rows at most
    sent = own.sparkSession.sparkContext.broadcast((_bit_table(sizes.select("least")), hot))

    def run(batches):
        (bits, parts), seen = sent.value, set()
        for batch in batches:
            rows, out = [], []
            for row, node, s in _nodes(batch.column(0), words):
                least = int(s[:1].view(np.int64)[0])
                if node not in seen and _has_bit(bits, np.array([least]))[0]:
                    seen.add(node)
                    rows.append(row)
                    out.append((least, (node >> 20) % parts[least] if least in parts else -1, len(s), node))
            if rows:
                cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*cols, batch.column(0).take(pa.array(rows))], ["least", "part", "size", "node", "text"])

    texts = own.select("text").mapInArrow(run, "least long, part int, size int, node long, text string")
    found = written(_met(texts, words, percent))
    firsts = found.where("a is null").select("least", F.lit(-1).alias("part"), "size", "node", "text")
    again = written(_met(firsts, words, percent))
    return found.union(again).where("a is not null").select("a", "b", "overlap", "linked")


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """Entries with a possible partner, by runs of sizes."""
    by_size = Window.partitionBy("token").orderBy("size", "node")
    near = lambda small, large: F.col(large) * percent <= F.col(small) * 100
    rows = (postings.withColumn("_ps", F.lag("size").over(by_size)).withColumn("_pn", F.lag("node").over(by_size))
            .withColumn("_ns", F.lead("size").over(by_size)).withColumn("_nn", F.lead("node").over(by_size)))
    joined = F.col("_ps").isNotNull() & (F.col("size") * percent <= F.col("_ps") * 100)
    followed = F.col("_ns").isNotNull() & (F.col("_ns") * percent <= F.col("size") * 100)
    rows = rows.withColumn("run", F.sum(F.when(joined, 0).otherwise(1)).over(by_size).cast("int"))
    rows = rows.where((joined & (F.col("_pn") != F.col("node"))) | (followed & (F.col("_nn") != F.col("node"))))
    return rows.select("token", "node", "size", "pos", "run").dropDuplicates(["token", "node"])


def _needed(sizes, percent: int):
    """Least overlap of two sets of so many shingles in all: ceil(p * (x + y) / (100 + p))."""
    return F.ceil(sizes * percent / F.lit(100.0 + percent) - 1e-9)


def _possible(x, y, percent: int):
    """Length and positional bound for two entries of one list."""
    low, high = F.least(x["size"], y["size"]), F.greatest(x["size"], y["size"])
    rest = F.least(x["size"] - x["pos"], y["size"] - y["pos"])
    return (high * percent <= low * 100) & (rest >= _needed(low + high, percent))


def _texts(own: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, text`` of one row of each wanted node (``node`` only).

    A table of bits of the wanted rows' ids goes to the tasks, so hardly any
    other text moves.  The texts' nodes are found in the same step: a second one
    behind the join, in the same tasks, would hold a Python process of its own
    for each core.
    """
    one = written(nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("id").alias("rid")))
    spot = F.xxhash64(F.col("id").cast("string"))
    sent = own.sparkSession.sparkContext.broadcast(_bit_table(one.select(F.xxhash64(F.col("rid").cast("string")))))

    def run(batches):
        for batch in batches:
            hit = _has_bit(sent.value, batch.column(2).to_numpy())
            if hit.any():
                yield _with_nodes(batch.filter(pa.array(hit)).select([0, 1]), words)

    few = own.select("id", "text", spot.alias("spot")).mapInArrow(
        run, f"id {own.schema['id'].dataType.simpleString()}, text string, node long, n_shingles long")
    rows = few.join(one, (few["node"] == one["node"]) & few["id"].eqNullSafe(F.col("rid")))
    return rows.select(one["node"], "text").dropDuplicates(["node"])


def _spare(x, y, percent: int):
    """Twice what a bound on the overlap, from the signatures, has beyond what a
    link needs; a pair below 0 has no link."""
    apart = sum(F.bit_count(x["sig"][k].bitwiseXOR(y["sig"][k])) for k in range(SIGNATURE // 64))
    sizes = x["size"] + y["size"]
    return sizes - apart - 2 * _needed(sizes, percent)


def _weighed(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs that the signatures leave open, with ``spare``."""
    left = signs.select(F.col("node").alias("a"), F.struct("size", "sig").alias("x"))
    right = signs.select(F.col("node").alias("b"), F.struct("size", "sig").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select(*pairs.columns, _spare(F.col("x"), F.col("y"), percent).alias("spare")).where("spare >= 0")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b, overlap, linked`` of pairs of nodes, from their whole sets.

    Texts travel, being smaller than their sets, and one at a time: the text of
    ``a`` comes first, then those of its nodes ``b``.  A node ``a`` of many pairs
    has them dealt into parts of about ``HOT``, each with the text of ``a``.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(HOT)).cast("int").alias("parts"))
    heads = parts.join(texts, F.col("a") == F.col("node")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
    others = pairs.join(parts, "a").join(texts, F.col("b") == F.col("node")).select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b", "text")
    dealt = heads.union(others).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_()]

    def run(batches):
        x = None
        for batch in batches:
            a, b, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for row, _, s in _nodes(batch.column(3), words):
                if b[row] is None:
                    x = s
                    continue
                n = _overlap(x, s)
                out.append((a[row], b[row], n, 100 * n >= percent * (len(x) + len(s) - n)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["a", "b", "overlap", "linked"])

    return dealt.mapInArrow(run, "a long, b long, overlap int, linked boolean")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _open(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries of the lists that hold several classes, with their class and
    ``lead``, the first entry of the list."""
    own = lists.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = own.groupBy("token", "run").agg(
        F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.min(F.struct("size", "node", "pos", "comp")).alias("lead")).where("_lo != _hi")
    return own.join(several.select("token", "run", "lead"), ["token", "run"])


def _pair(p, q):
    """The two nodes ``a, b`` and their classes ``ca, cb``."""
    return [F.least(p["node"], q["node"]).alias("a"), F.greatest(p["node"], q["node"]).alias("b"),
            F.least(p["comp"], q["comp"]).alias("ca"), F.greatest(p["comp"], q["comp"]).alias("cb")]


def _near_pairs(entries: DataFrame, percent: int, turn: int) -> DataFrame:
    """``a, b, ca, cb``: pairs of sets of two classes, from each entry with the head
    of its list and with the ``NEAR`` entries before it in order of size.  Entries
    of one size have another order in each ``turn``."""
    by_size = Window.partitionBy("token", "run").orderBy("size", F.xxhash64("node", F.lit(turn)), "node")
    me = F.struct("size", "node", "pos", "comp")
    near = entries.select(me.alias("p"), F.array("lead", *[F.lag(me, k).over(by_size) for k in range(1, NEAR + 1)]).alias("others"))
    p = F.col("p")
    one = near.select("p", F.explode(F.filter("others", lambda q: (q["comp"] != p["comp"]) & _possible(p, q, percent))).alias("q"))
    return one.select(*_pair(p, F.col("q"))).distinct()


def _likeliest(pairs: DataFrame) -> DataFrame:
    """``a, b``: one pair of sets for each two classes."""
    return pairs.groupBy("ca", "cb").agg(F.max(F.struct("spare", "a", "b")).alias("p")).select("p.a", "p.b")


def _remaining(entries: DataFrame, answers: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different classes that neither the answers of the lists' first sets
    nor the signatures settle: ``a, b, ca, cb, spare``."""
    own = entries.withColumn("first", F.col("lead.node")).join(signs.select("node", "sig"), "node")
    both = answers.select("a", "b", "overlap").union(answers.select("b", "a", "overlap"))
    with_first = both.groupBy(F.col("a").alias("first"), F.col("b").alias("node")).agg(F.max("overlap").alias("o"))
    own = own.join(with_first, ["first", "node"], "left")
    same = F.col("node") == F.col("first")
    inside = F.when(same, F.col("size")).otherwise(F.coalesce("o", "size"))  # most that the set shares with the first
    outside = F.when(same, F.lit(0)).otherwise(F.col("size") - F.coalesce("o", F.lit(0)))  # most that it has beside
    by_class = Window.partitionBy("token", "run").orderBy("comp", "size", "node")
    blocks = (own.withColumn("block", F.floor((F.row_number().over(by_class) - 1) / BLOCK))
              .groupBy("token", "run", "block").agg(
                  F.min("size").alias("lo"), F.max("size").alias("hi"), F.max(F.col("size") - F.col("pos")).alias("rest"),
                  F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                  F.collect_list(F.struct("node", "size", "pos", "comp", "sig", inside.alias("inside"), outside.alias("outside"))).alias("entries")))  # at most BLOCK
    x, y = blocks.alias("x"), blocks.alias("y")
    one_class = (F.col("x.c0") == F.col("y.c1")) & (F.col("x.c1") == F.col("y.c0")) & (F.col("x.c0") == F.col("x.c1"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.run") == F.col("y.run")) & (F.col("x.block") <= F.col("y.block")) & ~one_class
                 & (F.col("y.lo") * percent <= F.col("x.hi") * 100) & (F.col("x.lo") * percent <= F.col("y.hi") * 100)
                 & (F.least("x.rest", "y.rest") >= _needed(F.col("x.lo") + F.col("y.lo"), percent)))
    one = met.select(F.explode("x.entries").alias("p"), F.col("y.entries").alias("others"))

    def open_pair(q):
        p = F.col("p")
        bound = F.least(p["inside"], q["inside"]) + F.least(p["outside"], q["outside"])
        return ((p["comp"] != q["comp"]) & _possible(p, q, percent) & (bound >= _needed(p["size"] + q["size"], percent))
                & (_spare(p, q, percent) >= 0))

    two = one.select("p", F.explode(F.filter("others", open_pair)).alias("q"))
    p, q = F.col("p"), F.col("q")
    return two.select(*_pair(p, q), _spare(p, q, percent).alias("spare")).distinct()


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs of nodes whose classes still differ."""
    ends = [comps.select(F.col("node").alias(n), F.col("comp").alias(f"_{n}")) for n in "ab"]
    both = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return both.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``id, node, n_shingles, class, component_id`` of each row.

    Rows of one ``node`` have the same words; rows of one ``class`` are linked,
    directly or through others, and ``component_id`` is their smallest id.
    """
    bound_batches(docs.sparkSession)
    own = keyed_texts(docs, id_col, text_col)
    scan = written(_scanned(own, words))
    nodes = scan.where("part is null").drop("part", "counts")
    signs = nodes.where("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
    answers = _first_answers(own, nodes, words, percent)
    comps = components(answers.where("linked").select("a", "b"))
    lists = written(_lists(_postings(own, words, percent, _counted(scan)), percent))

    def unknown(pairs: DataFrame) -> DataFrame:
        known = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return pairs.join(known, ["a", "b"], "left_anti")

    def settled(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs)
        return written(_verified(pairs, written(_texts(own, nodes, _ends(pairs), words)), words, percent))

    entries = lists
    for turn in range(2):  # classes that meet near each other in a list
        entries = written(_open(entries.select("token", "node", "size", "pos", "run"), comps))
        answers = answers.union(settled(_likeliest(_weighed(unknown(_near_pairs(entries, percent, turn)), signs, percent))))
        comps = components(answers.where("linked").select("a", "b"))
    entries = written(_open(entries.select("token", "node", "size", "pos", "run"), comps))
    pairs = written(unknown(_remaining(entries, answers, signs, percent)))
    answers = answers.union(settled(_likeliest(pairs)))
    comps = components(answers.where("linked").select("a", "b"))
    more = settled(unknown(_apart(pairs, comps)))
    comps = components(answers.union(more).where("linked").select("a", "b"))
    full = nodes.select("id", "node", "n_shingles").join(comps, "node", "left").withColumn("class", F.coalesce("comp", "node"))
    smallest = full.where("n_shingles > 0").groupBy("class").agg(F.min("id").alias("component_id"))
    linked = full.where("n_shingles > 0").join(smallest, "class").select("id", "node", "n_shingles", "class", "component_id")
    alone = full.where("n_shingles = 0").select("id", "node", "n_shingles", "class", F.col("id").alias("component_id"))
    return linked.union(alone)


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps one row: the smallest
    id's, and among rows repeating that id the one of the smallest node.  Rows
    without words all stay."""
    found = written(jaccard_classes(docs, id_col, text_col, words, percent))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
    kept = found.where("n_shingles > 0").groupBy("class").agg(first.alias("k")).select(F.col("k.id").alias("_kid"), F.col("k.node").alias("_knode"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = text_nodes(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), row.alias("row")), words)
    out = tagged.where("n_shingles > 0").join(kept, (F.col("node") == F.col("_knode")) & F.col("id").eqNullSafe(F.col("_kid")), "left_semi")
    repeated = found.where("n_shingles > 0").groupBy("id", "node").count().where("count > 1")
    if not repeated.isEmpty():  # the same id and words in several rows: one of them
        out = out.dropDuplicates(["id", "node"])
    return out.union(tagged.where("n_shingles = 0")).select("row.*")


def q_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.d = e.a),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT w.doc_id, cast(coalesce(n.n, 0) AS bigint) AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.d = w.doc_id
"""
