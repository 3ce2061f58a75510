"""Many model fits at once: blocks of rows, fit programs, and their reductions.

The rows of every data cell (for instance one (repeat, fold)) are packed into
blocks of about ``block_rows`` rows: matrices that numpy works on.  A model is a
*fit program*: a generator that asks for statistics of its cell (``Ask``: a
function of one block, and whether blocks are added up or take the least) and
receives the total.  A program never sees rows.

* Fits whose cell is one block, or small enough to be held by a task (``whole``
  bytes of features), are run by one task over the cell, all in one Spark job.
  A forest is dealt into parts (``members`` of its program names the parameter
  that counts its trees), each a task of its own.
* Fits of larger cells run in lockstep: in each round the questions
  of all of them are answered by one job over all blocks.  Tasks add up their
  own blocks first, and their sums meet in two levels, so the number of jobs is
  the number of questions of the longest program, whatever the number of fits,
  cells or rows.

Both ways run the same programs; a task that is lost is computed again from the
written blocks.  The driver holds one total for each fit, whose size is that of
the question (nodes x features, or features squared), never rows.
"""
from __future__ import annotations

import functools
import io
import json
import math
import uuid
from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pa_dataset
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import ensure_checkpoint_dir

BLOCK_ROWS = 8192
SALTS = 32
WHOLE_BYTES = 48 << 20  # features of a cell that one task may hold as a whole
TASKS_A_CORE = 3  # tasks that forests are dealt into
MEMBER_ROWS = 2_000_000  # rows x trees that a task grows at once


@dataclass
class Ask:
    """A question to all blocks of a cell: ``of(block, **args)`` gives an array."""
    of: Callable
    args: dict = field(default_factory=dict)
    least: bool = False  # totals are minima instead of sums


@dataclass
class Block:
    name: tuple
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    key: np.ndarray
    kept: dict | None = None  # what a program's answers keep from question to question, where one task answers them all


#: a fit program takes the number of features, its parameters and a seed, and returns named arrays
Program = Callable[[int, dict, int], Generator[Ask, np.ndarray, dict]]


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def block_table(rows: DataFrame, cell: Sequence[str], features: str = "xs", label: str = "label", weight: str | None = "weight",
                key: str = "row_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``cell…, block, blocks, n, x, y, w, key``: each cell's rows in blocks, dealt
    by the hash of their key and ordered by it.  ``key`` is an integer column."""
    cell = list(cell)
    own = rows.select(*cell, F.col(key).cast("long").alias("key"), F.col(label).cast("double").alias("y"),
                      (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), F.col(features).alias("x"))
    counts = own.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    dealt = own.join(counts, cell).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    schema = T.StructType([rows.schema[c] for c in cell]).add("block", T.IntegerType()).add("blocks", T.IntegerType()).add("n", T.LongType())
    for c in ("x", "y", "w", "key"):
        schema = schema.add(c, T.BinaryType())
    arrow = to_arrow_schema(schema)

    def pack(keys, table):
        table = table.take(np.lexsort((table.column("y").to_numpy(), table.column("key").to_numpy())))
        flat = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")
        out = {c: [k.as_py()] for c, k in zip([*cell, "block"], keys)}
        out.update(blocks=[table.column("blocks")[0].as_py()], n=[len(table)], x=[flat.tobytes()], y=[table.column("y").to_numpy().astype("<f8").tobytes()],
                   w=[table.column("w").to_numpy().astype("<f8").tobytes()], key=[table.column("key").to_numpy().astype("<i8").tobytes()])
        return pa.table(out, schema=arrow)

    return dealt.groupBy(*cell, "block").applyInArrow(pack, schema)


def _block(row: dict, name: tuple, features: int | None) -> Block:
    x = np.frombuffer(row["x"], "<f8").reshape(row["n"], -1)
    return Block(name, x[:, :features] if features else x, *(np.frombuffer(row[c], k) for c, k in (("y", "<f8"), ("w", "<f8"), ("key", "<i8"))))


def _merged(rows: list[dict], name: tuple, features: int | None) -> Block:
    """Rows of ``block_table`` as one block."""
    blocks = [_block(r, name, features) for r in rows]
    if len(blocks) == 1:
        return blocks[0]
    return Block(name, *(np.concatenate([getattr(b, c) for b in blocks]) for c in ("x", "y", "w", "key")))


def answered(program: Generator[Ask, np.ndarray, dict], block: Block) -> dict:
    """Run a program to its end over one block."""
    block = replace(block, kept={})
    ask = next(program)
    while True:
        try:
            ask = program.send(ask.of(block, **ask.args))
        except StopIteration as end:
            return end.value


def _width(params: dict, d: int) -> int:
    return min(d, int(params.get("mrmr_k", d)))


def in_parts(program: Program, d: int, params: dict, seed: int, block: Block, members: int | None = None) -> dict:
    """The model of one block: ``members`` trees of a forest at once (no more than
    ``MEMBER_ROWS`` allows), so that what the task holds is bounded."""
    name = getattr(program, "members", None)
    if name is None:
        return answered(program(d, params, seed), block)
    count, first = int(params[name]), int(params.get("first", 0))
    step = max(1, members or MEMBER_ROWS // max(1, len(block.x)))
    return joined([answered(program(d, {**params, name: min(step, count - lo), "first": first + lo}, seed), block) for lo in range(0, count, step)])


def joined(models: list[dict]) -> dict:
    """One forest of the trees of several (flat arrays, see ``trees``)."""
    if len(models) == 1:
        return models[0]
    starts = np.cumsum([0, *(len(m["feature"]) for m in models)])
    return {k: np.concatenate([m[k] + (np.where(m["feature"] >= 0, lo, 0) if k == "left" else lo if k == "roots" else 0) for m, lo in zip(models, starts)]).astype(models[0][k].dtype)
            for k in models[0]}


def _units(fits: list, cells: dict[tuple, tuple], cell: list[str], programs: dict[str, Program], cores: int) -> list[tuple]:
    """``fit, part, slot, params`` of every task: the costliest first."""
    units, parts = [], max(1, math.ceil(TASKS_A_CORE * cores / max(1, len(fits))))
    for f in fits:
        params, name = json.loads(f["params"]), getattr(programs[f["program"]], "members", None)
        rows, count = cells[tuple(f[c] for c in cell)][1], int(params[name]) if name else 0
        cost = rows * float(params.get("n_estimators", 1)) * 2.0 ** min(3, float(params.get("max_depth", 1)) / 4) * float(params.get("C", 1.0)) ** 0.1
        ends = np.linspace(0, count, min(parts, count) + 1).astype(int) if name else [0, 0]
        for part, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
            own = {**params, name: int(hi - lo), "first": int(lo)} if name else params
            units.append((cost / (len(ends) - 1), f["fit"], part, json.dumps(own)))
    units.sort(key=lambda u: (-u[0], u[1], u[2]))
    return [(fit, part, slot, params) for slot, (_, fit, part, params) in enumerate(units)]


def _dealt(units: DataFrame, n: int) -> DataFrame:
    """``units`` with ``deal``: a number for each slot so that a shuffle by it into
    ``n`` partitions gives every slot a partition of its own, in the order of slots."""
    spark = units.sparkSession
    tried = spark.range(40 * n + 100).select(F.col("id").cast("int").alias("deal"))
    falls = tried.groupBy(F.pmod(F.hash("deal"), F.lit(n)).alias("slot")).agg(F.min("deal").alias("deal"))
    return units.join(F.broadcast(falls), "slot", "left").withColumn("deal", F.coalesce("deal", "slot"))  # one row for each task


def fit_cells(blocks: DataFrame, fits: DataFrame, cell: Sequence[str], programs: dict[str, Program], seed: int = 42, whole: int = 0, parted: bool = False) -> DataFrame:
    """``fit, model``: the packed model of every row of ``fits``.

    ``fits`` holds ``fit`` (int), the cell columns, ``program`` (a name) and
    ``params`` (JSON; ``mrmr_k`` limits the fit to so many leading features).
    A cell without rows gives no model.  Cells of one block, or of up to ``whole``
    bytes of features, are fitted as a whole by one task.  ``parted``: forests stay
    in their parts, ``fit, part, members, model`` (so many trees)."""
    cell, spark = list(cell), blocks.sparkSession
    sizes = blocks.groupBy(*cell).agg(F.max("blocks").alias("blocks"), F.sum("n").alias("n"), F.sum(F.length("x")).alias("bytes")).collect()  # one row for each cell
    cells = {tuple(r[c] for c in cell): (r["blocks"] == 1 or r["bytes"] <= whole, r["n"], r["bytes"] // 8 // r["n"]) for r in sizes}
    rows = [r for r in fits.select("fit", *cell, "program", "params").collect() if tuple(r[c] for c in cell) in cells]  # one row for each fit
    near, far = ([r for r in rows if cells[tuple(r[c] for c in cell)][0] == kind] for kind in (True, False))
    units = _units(near, cells, cell, programs, spark.sparkContext.defaultParallelism)
    told = spark.createDataFrame(units, "fit int, part int, slot int, params string").join(fits.select("fit", *cell, "program"), "fit")
    n = max(1, len(units))
    work = blocks.join(F.broadcast(_dealt(told, n)), cell).select("fit", "part", "program", "params", "deal", "block", "blocks", "n", "x", "y", "w", "key")

    def local(batches):
        waiting = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = waiting.setdefault((row["fit"], row["part"]), [])
                own.append(row)
                if len(own) < row["blocks"]:
                    continue
                params, d = json.loads(row["params"]), len(row["x"]) // 8 // row["n"]
                width = _width(params, d)
                block = _merged(sorted(waiting.pop((row["fit"], row["part"])), key=lambda r: r["block"]), (row["fit"], 0), width)
                model = in_parts(programs[row["program"]], width, params, seed, block)
                yield pa.RecordBatch.from_pydict({"fit": pa.array([row["fit"]], pa.int32()), "part": pa.array([row["part"]], pa.int32()),
                                                  "members": pa.array([len(model["roots"]) if "roots" in model else 1], pa.int32()), "model": pa.array([packed(model)], pa.binary())})

    found = work.repartition(n, "deal").mapInArrow(local, PART)
    if far:
        heads = [{**r.asDict(), "d": cells[tuple(r[c] for c in cell)][2]} for r in far]
        wanted = spark.createDataFrame(sorted({tuple(r[c] for c in cell) for r in far}), T.StructType([blocks.schema[c] for c in cell]))
        found = found.union(_lockstep(blocks.join(F.broadcast(wanted), cell), cell, heads, programs, seed))  # one row for each cell
    if parted:
        return found
    if len(units) == len(near):
        return found.select("fit", "model")

    def meet(keys, table):
        models = [unpacked(m.as_py()) for m in table.sort_by("part").column("model")]
        return pa.table({"fit": pa.array([keys[0].as_py()], pa.int32()), "model": pa.array([packed(joined(models))], pa.binary())})

    return found.groupBy("fit").applyInArrow(meet, "fit int, model binary")


PART = "fit int, part int, members int, model binary"


def _lockstep(blocks: DataFrame, cell: list[str], heads: list, programs: dict[str, Program], seed: int) -> DataFrame:
    spark = blocks.sparkSession
    running, asks, models, members, cells = {}, {}, {}, {}, {}
    for h in heads:
        params = json.loads(h["params"])
        running[h["fit"]] = programs[h["program"]](_width(params, h["d"]), params, seed)
        asks[h["fit"]] = next(running[h["fit"]])
        cells.setdefault(tuple(h[c] for c in cell), []).append(h["fit"])
    widths = {h["fit"]: _width(json.loads(h["params"]), h["d"]) for h in heads}
    shape = T.StructType([blocks.schema[c] for c in cell]).add("fits", T.ArrayType(T.IntegerType()))
    told = spark.createDataFrame([(*k, sorted(v)) for k, v in cells.items()], shape)
    # told: one row for each cell.  A block goes to its task once, whatever the number of its fits,
    # and blocks are spread over all tasks once, not read again in as few parts as their files give
    own = blocks.join(F.broadcast(told), cell)
    work = own.repartition(max(1, min(own.count(), 4 * spark.sparkContext.defaultParallelism))).persist()
    while asks:
        totals = _totals(work.where(F.arrays_overlap("fits", F.array(*[F.lit(f) for f in sorted(asks)]))), asks, widths)
        for fit in list(asks):
            try:
                asks[fit] = running[fit].send(totals[fit])
            except StopIteration as end:
                del asks[fit]
                models[fit], members[fit] = packed(end.value), len(end.value["roots"]) if "roots" in end.value else 1
    work.unpersist()
    return spark.createDataFrame([(f, 0, members[f], bytearray(m)) for f, m in models.items()], PART)


def _totals(work: DataFrame, asks: dict[int, Ask], widths: dict[int, int]) -> dict[int, np.ndarray]:
    """The answers of all blocks to the questions of their ``fits``, in one job."""
    spark = work.sparkSession
    sent = spark.sparkContext.broadcast(asks)

    def met(old, new, least):
        return new if old is None else np.minimum(old, new) if least else old + new

    def partial(batches):
        sums = {}
        for batch in batches:
            for row in batch.to_pylist():
                for fit in row["fits"]:
                    ask = sent.value.get(fit)
                    if ask is None:  # this fit has ended
                        continue
                    got = np.asarray(ask.of(_block(row, (fit, row["block"]), widths[fit]), **ask.args), float)
                    sums[fit] = met(sums.get(fit), got, ask.least)
        for fit, total in sums.items():
            yield pa.RecordBatch.from_pydict({"fit": pa.array([fit], pa.int32()), "total": pa.array([total.astype("<f8").tobytes()], pa.binary())})

    def merge(keys, table):
        fit, total = keys[0].as_py(), None
        for t in table.column("total"):
            total = met(total, np.frombuffer(t.as_py(), "<f8"), sent.value[fit].least)
        return pa.table({"fit": pa.array([fit], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    shape = "fit int, total binary"
    parts = work.mapInArrow(partial, shape).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    first = parts.groupBy("fit", "salt").applyInArrow(lambda k, t: merge(k, t), shape)
    rows = first.groupBy("fit").applyInArrow(lambda k, t: merge(k, t), shape).collect()  # one total for each fit
    sent.unpersist()
    return {r["fit"]: np.frombuffer(r["total"], "<f8") for r in rows}


def scored(blocks: DataFrame, work: DataFrame, score: Callable) -> DataFrame:
    """``fit, <cell columns of blocks>, row_id, y_true, score, converged`` of every
    row of ``work``'s blocks: ``score(row, params, block)`` gives the scores and the flag."""
    own = [c for c in blocks.columns if c not in ("block", "blocks", "n", "x", "y", "w", "key")]
    schema = T.StructType([blocks.schema[c] for c in own] + [T.StructField(c, t) for c, t in (
        ("fit", T.IntegerType()), ("row_id", T.LongType()), ("y_true", T.IntegerType()), ("score", T.DoubleType()), ("converged", T.BooleanType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                params = json.loads(row["params"])
                b = _block(row, (row["fit"], row["block"]), _width(params, len(row["x"]) // 8 // max(1, row["n"])))
                found, flag = score(row, params, b)
                out = {c: [row[c]] * row["n"] for c in own}
                known = np.nan_to_num(b.y).astype(np.int32)
                out.update(fit=[row["fit"]] * row["n"], row_id=b.key, y_true=pa.array(known, pa.int32(), mask=np.isnan(b.y)), score=found, converged=[flag] * row["n"])
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return work.mapInArrow(run, schema)


def file_batches(files: Sequence[str], rows: int, where=None):
    """Rows of parquet files in Arrow tables of ``rows`` at most, one at a time."""
    for file in files:
        store, path = pa_fs.FileSystem.from_uri(file)
        found = pa_dataset.dataset(path, filesystem=store, format="parquet")
        for batch in found.to_batches(batch_size=rows, batch_readahead=1, fragment_readahead=1, use_threads=False, filter=where):
            if len(batch):
                yield pa.Table.from_batches([batch])


def block_files(blocks: DataFrame) -> list[str]:
    """The files of a table of blocks; one that is not written yet is written to the shared checkpoint folder."""
    files = blocks.inputFiles()
    if not files:
        path = f"{ensure_checkpoint_dir(blocks.sparkSession).rstrip('/')}/blocks-{uuid.uuid4().hex}"
        blocks.write.parquet(path)
        files = blocks.sparkSession.read.schema(blocks.schema).parquet(path).inputFiles()
    return files


def blocks_of(files: list[str], cell: dict):
    """The blocks of one cell as dicts, one at a time."""
    where = functools.reduce(lambda a, b: a & b, [pa_dataset.field(c) == v for c, v in cell.items()])
    for table in file_batches(files, 1, where):
        yield from table.to_pylist()


def score_cells(blocks: DataFrame, fits: DataFrame, models: DataFrame, cell: Sequence[str], scorers: dict[str, Callable]) -> DataFrame:
    """``fit, <cell columns of blocks>, row_id, y_true, score, converged`` of every
    row of ``blocks`` for each fit of its cell (``fits``' cell columns).  A model, the
    larger of the two, goes to one task, which reads the cell's blocks from their
    files.  Forests in parts (``fit_cells``) score by their trees' mean: the parts'
    sums meet by block."""
    cell, files, parted = list(cell), block_files(blocks), "part" in models.columns
    own = [c for c in blocks.columns if c not in ("block", "blocks", "n", "x", "y", "w", "key")]
    told = models.join(F.broadcast(fits.select("fit", *cell, "program", "params")), "fit")  # fits: one row for each fit
    tasks = min(1000, 4 * max(1, fits.count()) * (TASKS_A_CORE if parted else 1))
    work = told.repartition(tasks, *(["fit", "part"] if parted else ["fit"]))
    out = T.StructType([blocks.schema[c] for c in own] + [T.StructField(c, t) for c, t in (
        ("fit", T.IntegerType()), ("row_id", T.LongType()), ("y_true", T.IntegerType()), ("score", T.DoubleType()), ("converged", T.BooleanType()))])
    sums = T.StructType([blocks.schema[c] for c in own] + [T.StructField(c, t) for c, t in (
        ("fit", T.IntegerType()), ("block", T.IntegerType()), ("part", T.IntegerType()), ("members", T.IntegerType()),
        ("y", T.BinaryType()), ("key", T.BinaryType()), ("total", T.BinaryType()))])
    arrow, arrow_sums = to_arrow_schema(out), to_arrow_schema(sums)

    def rows(of, key, y, score, flag):
        return {**{c: [of[c]] * len(key) for c in [*own, "fit"]}, "row_id": key, "y_true": y.astype(np.int32), "score": score, "converged": [flag] * len(key)}

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                params, model = json.loads(row["params"]), unpacked(row["model"])
                flag = bool(model["converged"]) if "converged" in model else None
                for held in blocks_of(files, {c: row[c] for c in cell}):
                    b = _block(held, (row["fit"], held["block"]), _width(params, len(held["x"]) // 8 // max(1, held["n"])))
                    score, of = scorers[row["program"]](model, b.x), {**{c: held[c] for c in own}, "fit": row["fit"]}
                    if not parted:
                        yield pa.RecordBatch.from_pydict(rows(of, b.key, b.y, score, flag), schema=arrow)
                    else:
                        total = (score * row["members"]).astype("<f8").tobytes()
                        yield pa.RecordBatch.from_pylist([{**of, "block": held["block"], "part": row["part"], "members": row["members"], "y": held["y"], "key": held["key"], "total": total}], schema=arrow_sums)

    def meet(keys, table):
        found = table.sort_by("part").to_pylist()
        score = sum(np.frombuffer(r["total"], "<f8") for r in found) / sum(r["members"] for r in found)
        return pa.table(rows(found[0], np.frombuffer(found[0]["key"], "<i8"), np.frombuffer(found[0]["y"], "<f8"), score, None), schema=arrow)

    if not parted:
        return work.mapInArrow(run, out)
    return work.mapInArrow(run, sums).groupBy(*own, "fit", "block").applyInArrow(meet, out)
