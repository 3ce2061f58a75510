"""Result sinks in the file formats that ``tables`` reads back.

Each writes a folder through Spark's writers, whose commit leaves whole files
only.  The two-header summary and the JSON documents are results of a bounded
size (models × metrics, one row, top-k), and become one file.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import METRIC_COLUMNS


def write_csv(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_summary_two_header(summary: DataFrame, path: str, stats: tuple[str, ...] = ("mean", "std")) -> None:
    """``(model, metric, stat, value)`` as a CSV whose columns have two
    header rows (metric, stat) above an index-name row."""
    cols = [(m, s) for m in METRIC_COLUMNS for s in stats]
    cell = [F.max(F.when((F.col("metric") == m) & (F.col("stat") == s), F.col("value").cast("string"))) for m, s in cols]
    body = summary.groupBy("model").agg(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cell]).alias("_cells"))
    body = body.select(F.lit(3).alias("_k"), "model", F.concat_ws(",", "model", "_cells").alias("value"))
    head = [(0, "", ",".join(["", *(m for m, _ in cols)])), (1, "", ",".join(["", *(s for _, s in cols)])),
            (2, "", ",".join(["model", *("" for _ in cols)]))]
    heads = summary.sparkSession.createDataFrame(head, "_k int, model string, value string")
    lines = heads.unionByName(body).coalesce(1).sortWithinPartitions("_k", "model")
    lines.select("value").write.mode("overwrite").text(path)


def write_json_document(row: DataFrame, path: str) -> None:
    """A one-row result as one JSON object."""
    row.select(F.to_json(F.struct(*row.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_json_pairs(ranked: DataFrame, path: str, name: str = "name", value: str = "value", rank: str = "rank") -> None:
    """A top-k list as a JSON array of ``[name, value]`` in rank order."""
    pair = F.concat(F.lit("["), F.regexp_extract(F.to_json(F.struct(F.col(name).alias("x"))), r'^\{"x":(.*)\}$', 1),
                    F.lit(", "), F.col(value).cast("string"), F.lit("]"))
    items = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), pair.alias("p"))))  # k rows
    text = ranked.agg(items.alias("s")).select(F.concat(F.lit("["), F.array_join("s.p", ", "), F.lit("]")).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)
