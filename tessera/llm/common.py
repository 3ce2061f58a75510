"""Helpers shared by the operators: written tables, hash samples, exact ranks."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that texts go to the tasks in by bytes, unless the
    session says how.  Spark bounds them by rows alone, and a batch of 10,000 long
    texts lies whole in the JVM's and in the worker's memory."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared folder and read it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only what an operator reads, under names of its own: ``id`` and ``text``.

    Extra columns of the input, whatever their names, end here.
    """
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def crc_fold(id_col: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id falls in fold 0)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string")) % folds, F.lit(0)).cast("int")


def hash_sample(df: DataFrame, key: str, classes: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of every class, chosen by the hash of ``key``.

    One small aggregate counts the classes; each row then stays if its hash
    falls below the class's share.  The expected size is ``per_class`` at most,
    whatever the input size, and the choice does not depend on row order.
    """
    counts = df.groupBy(classes).count().collect()
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(classes).eqNullSafe(F.lit(r[0])), F.lit(min(1.0, per_class / r[1]))).otherwise(share)
    spot = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return df.where(spot < share)


def exact_ranks(df: DataFrame, group: list[str], order: list[str], salts: int = 256) -> DataFrame:
    """Add ``rank``: a gapless number from 0 within each ``group`` (never null).

    The rows of a group are spread over ``salts`` hash buckets of ``order``.
    A bucket is numbered by its own window, and the bucket's first number comes
    from prefix sums over at most ``salts`` counts for each group, so a group
    holding any share of all rows is never sorted in one task.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salts)).cast("int"))
    counts = salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_salt").alias("_s"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*group, "_salt").orderBy(*order)
    numbered = salted.withColumn("_r", F.row_number().over(within) - 1)
    same = [F.col(g) == F.col(f"_g{i}") for i, g in enumerate(group)] + [F.col("_salt") == F.col("_s")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return numbered.join(firsts, cond).select(*df.columns, (F.col("_first") + F.col("_r")).cast("long").alias("rank"))
