"""Corpus pipeline: documents in, packed sequences out.

Stages, each on all rows that the stage before it kept:

1. ``quality``: the sparse rule ensemble rejects documents that score below 0.3;
2. ``near_duplicates``: one document of each Jaccard class stays;
3. ``decontamination``: documents that hold a window of a benchmark item go;
4. ``secrets``: confirmed and pattern secrets in the texts are masked;
5. ``packing``: what is left is packed into sequences of at most 1024 tokens.

Stages 1 to 4 return the columns of ``documents``.  Null texts count as empty and
stay null; repeated rows are near duplicates of each other unless they have no
words; an empty table passes through.  Very long texts are worked on whole; texts
go to the tasks in Arrow batches of bounded bytes, a longer text in one of its own.
Other columns than those of ``documents`` are dropped.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, decontaminate, jaccard_join, rule_ensemble, secret_scan
from tessera.llm.common import bound_batches, documents, written
from tessera.llm.text_stats import with_stats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(docs: DataFrame) -> DataFrame:
    """``id, text, row``: the columns of ``documents`` travel as one struct, so
    that no name of theirs can clash with an operator's."""
    return docs.select(F.col("doc_id").alias("id"), F.col("text"), F.struct(*COLUMNS).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels are those of the input's own documents."""
    bound_batches(spark)
    model = rule_ensemble.trained(spark, docs, sf_dir)
    scored = with_stats(_rows(docs)).withColumn("_score", model.score())
    return scored.where(F.col("_score") >= rule_ensemble.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each_class(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_rows(docs.select(*COLUMNS), items)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the masked text."""
    bound_batches(spark)
    masked = secret_scan.redact(docs.select(*COLUMNS, F.col("text").alias("_old")))
    changed = ~F.col("text").eqNullSafe(F.col("_old"))
    return masked.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return best_fit_packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: A learned classifier and a tokenizer have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
