"""Table scans: the driver's parquet tables and the reference's file formats
(one CSV per class, long metric CSV, two-header summary CSV, JSON documents)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

METRIC_COLUMNS = ("accuracy", "precision", "recall", "f1", "macro_f1", "roc_auc",
                  "pr_auc", "balanced_accuracy", "brier")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; projection/filters applied later reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sample_csv_schema(n_features: int, index_col: str = "PatientIndex",
                      side_col: str = "SideStandard", prefix: str = "Feature_") -> T.StructType:
    """Explicit schema of a per-class sample CSV."""
    fields = [T.StructField(index_col, T.IntegerType()), T.StructField(side_col, T.StringType())]
    fields += [T.StructField(f"{prefix}{i:04d}", T.DoubleType()) for i in range(1, n_features + 1)]
    return T.StructType(fields)


def read_class_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One CSV per class with a header row. With no schema the header is read
    once to learn the width, then the file is scanned with an explicit schema."""
    if schema is None:
        header = spark.read.option("header", True).csv(path).columns
        fields = []
        for c in header:
            if c.startswith("Feature_"):
                fields.append(T.StructField(c, T.DoubleType()))
            elif c == "PatientIndex":
                fields.append(T.StructField(c, T.IntegerType()))
            else:
                fields.append(T.StructField(c, T.StringType()))
        schema = T.StructType(fields)
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .option("nanValue", "NaN").option("positiveInf", "inf").option("negativeInf", "-inf")
            .schema(schema).csv(path))


def metrics_long_schema() -> T.StructType:
    return T.StructType([T.StructField("model", T.StringType()), T.StructField("repeat", T.IntegerType())]
                        + [T.StructField(m, T.DoubleType()) for m in METRIC_COLUMNS])


def read_metrics_long(spark: SparkSession, path: str) -> DataFrame:
    """Long metric CSV ``model, repeat, nine metrics``."""
    return spark.read.option("header", True).schema(metrics_long_schema()).csv(path)


def read_summary_two_header(spark: SparkSession, path: str) -> DataFrame:
    """S3: summary CSV with two header rows (metric / stat) and an index-name row,
    returned long as ``(model, metric, stat, value)``."""
    raw = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    # the file is a few lines per model; header rows are the first three lines
    lines = raw.select(F.split("value", ",").alias("cells"), "line_no")
    first3 = lines.orderBy("line_no").limit(3).collect()
    metrics_row, stats_row = first3[0]["cells"], first3[1]["cells"]
    n = len(metrics_row)
    pairs = [(metrics_row[i], stats_row[i]) for i in range(1, n)]
    body = lines.filter(~F.col("line_no").isin([r["line_no"] for r in first3]))
    stack_args = ", ".join(f"'{m}', '{s}', cast(cells[{i}] as double)"
                           for i, (m, s) in enumerate(pairs, start=1))
    return body.selectExpr("cells[0] as model",
                           f"stack({len(pairs)}, {stack_args}) as (metric, stat, value)")


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Whole-document JSON (object per file)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of ``[name, value]`` pairs → ``(rank, name, value)``."""
    text = spark.read.text(path, wholetext=True)
    arr = F.from_json("value", "array<array<string>>")
    return (text.select(F.posexplode(arr).alias("pos", "pair"))
            .select((F.col("pos") + 1).alias("rank"),
                    F.col("pair")[0].alias("name"),
                    F.col("pair")[1].cast("double").alias("value")))
