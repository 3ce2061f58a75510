"""Token ids in files of fixed-width bit-packed blocks.

Every id takes the least number of bits that the vocabulary needs (16 for
50,257 ids; a vocabulary of 32,000 takes 15), so an id's place follows from its
number and any block can be unpacked with numpy without its neighbours.

One file, little-endian::

    magic "TSPK" | bits u32 | block ids u32 | documents u64 | ids u64 | blocks u64
    first id of each document  (documents + 1) x u64
    byte offset of each block in the payload  (blocks + 1) x u64
    payload: blocks of ``block ids`` ids (the last may be shorter), each byte-aligned
    document ids as one JSON list

Documents are ordered by id (nulls first), and by text where ids repeat; file k
holds a range of ids before file k + 1's.  Rows go to files by Spark's range
shuffle.  A task writes its file under a name of its own and then renames it,
so a task that runs twice leaves one whole file with the same content.  The
folder is below ``spark.checkpoint.dir`` unless given.

A null text is empty and has only the end id; repeated rows are written as
often as they come; an empty table gives no files and no rows; other columns
are not read.  Only file names and their counts reach the driver.
"""
from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import documents, keyed_texts, shared_folder
from tessera.llm.tokens import END, VOCABULARY, encoded, encoder

MAGIC = b"TSPK"
HEAD = struct.Struct("<4sIIQQQ")
BLOCK_IDS = 4096


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, least bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flat = ((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(flat.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[:count * bits].reshape(count, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


class Writer:
    """Collects ids and packs each full block; one document at a time."""

    def __init__(self, bits: int, block: int = BLOCK_IDS):
        self.bits, self.block = bits, block
        self.docs, self.firsts, self.blocks = [], [0], []
        self.open: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.firsts.append(self.firsts[-1] + len(ids))
        self.open.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * self.block:
            self._pack(self.waiting // self.block * self.block)

    def _pack(self, count: int) -> None:
        ids = np.concatenate(self.open) if self.open else np.zeros(0, "<u4")
        self.blocks += [pack(ids[k:min(k + self.block, count)], self.bits) for k in range(0, count, self.block)]
        self.open, self.waiting = [ids[count:]], len(ids) - count

    def parts(self):
        self._pack(self.waiting)
        yield HEAD.pack(MAGIC, self.bits, self.block, len(self.docs), self.firsts[-1], len(self.blocks))
        yield np.array(self.firsts, "<u8").tobytes()
        yield np.cumsum([0, *map(len, self.blocks)]).astype("<u8").tobytes()
        yield from self.blocks
        yield json.dumps(self.docs, separators=(",", ":")).encode()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        magic, self.bits, self.block, self.n_docs, self.n_ids, n = HEAD.unpack(source.read_at(HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        at = HEAD.size
        self.firsts = np.frombuffer(source.read_at(8 * (self.n_docs + 1), at), "<u8").astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.offsets = np.frombuffer(source.read_at(8 * (n + 1), at), "<u8").astype(np.int64)
        self.payload = at + 8 * (n + 1)

    def names(self) -> list:
        at = self.payload + int(self.offsets[-1])
        return json.loads(self.source.read_at(self.source.size() - at, at))

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi of the file: only the blocks that hold them are read."""
        if hi <= lo:
            return np.zeros(0, "<u4")
        a, b = lo // self.block, (hi - 1) // self.block + 1
        raw = self.source.read_at(int(self.offsets[b] - self.offsets[a]), self.payload + int(self.offsets[a]))
        base, out = int(self.offsets[a]), []
        for k in range(a, b):
            part = raw[int(self.offsets[k]) - base:int(self.offsets[k + 1]) - base]
            out.append(unpack(part, min(self.block, self.n_ids - k * self.block), self.bits))
        return np.concatenate(out)[lo - a * self.block:hi - a * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.firsts[k + 1]))


def write_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, end: int = END, files: int | None = None) -> list[tuple[str, int, int]]:
    """Write all documents; return (file, documents, ids) in order."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = keyed_texts(docs, id_col, text_col)
    ordered = own.repartitionByRange(files, F.col("id"), F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def write(batches):
        writer = Writer(bits_for(encoder(vocabulary).size))
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, ids in zip(names, encoded(batch.column(1), vocabulary)):
                writer.add(name, np.frombuffer(ids + struct.pack("<I", end), "<u4"))
        if not writer.docs:
            return
        at, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith(("/", "file:")) else f"file://{folder}")
        at.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        with at.open_output_stream(f"{path}/{name}.part") as out:
            for part in writer.parts():
                out.write(part)
        at.move(f"{path}/{name}.part", f"{path}/{name}.tok")
        yield pa.RecordBatch.from_pylist([{"file": f"{path}/{name}.tok", "first": json.dumps(writer.docs[0]), "n_docs": len(writer.docs), "n_ids": writer.firsts[-1]}])

    # the partition number orders the files: ranges of ids ascend with it
    made = ordered.mapInArrow(write, "file string, first string, n_docs long, n_ids long")
    rows = made.select("*", F.spark_partition_id().alias("k")).collect()  # one row for each file
    return [(r["file"], r["n_docs"], r["n_ids"]) for r in sorted(rows, key=lambda r: r["k"])]


def read_tokens(spark: SparkSession, files: list[tuple[str, int, int]], folder_uri: str, schema: str,
                of: Callable[[np.ndarray], object], docs_per_task: int = 4096) -> DataFrame:
    """One row for each document of the files: ``id, start, n_tokens, value``.

    ``of`` is applied to each document's ids; ``schema`` is that of the rows.
    A file's documents are dealt out in runs, which tasks read independently.
    """
    work, before = [], 0
    for file, n_docs, n_ids in files:
        work += [(file, lo, min(lo + docs_per_task, n_docs), before) for lo in range(0, n_docs, docs_per_task)]
        before += n_ids

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches):
        at, _ = fs.FileSystem.from_uri(folder_uri)
        for batch in batches:
            for row in batch.to_pylist():
                with at.open_input_file(row["file"]) as source:
                    reader = Reader(source)
                    names = reader.names()[row["lo"]:row["hi"]]
                    out = {"id": names, "start": [], "n_tokens": [], "value": []}
                    for k in range(row["lo"], row["hi"]):
                        ids = reader.document(k)
                        out["start"].append(row["before"] + int(reader.firsts[k]))
                        out["n_tokens"].append(len(ids))
                        out["value"].append(of(ids))
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    runs = spark.createDataFrame(work, "file string, lo long, hi long, before long")
    return runs.repartition(max(1, len(work)), F.col("file"), F.col("lo")).mapInArrow(read, schema)


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    files = write_tokens(documents(spark, sf_dir), folder)
    return read_tokens(spark, files, folder, "id long, start long, n_tokens long, value long",
                       lambda ids: zlib.crc32(ids.tobytes())).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("value").alias("ids_crc32"))
