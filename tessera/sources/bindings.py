"""Bindings: the evaluation data model expressed over the driver's tables.

* ``pred_scores``  (PRED)  scored predictions ``(model, repeat, group_id, y_true, proba)``
* ``wide_samples`` (WIDE)  grouped wide feature rows ``(row_id, label, patient_id, side, features)``
* ``wide_long``            the same as ``(row_id, ..., feature_idx, value)``
* ``groups_tall`` / ``mixed_events`` / ``doc_samples`` — other grouped label tables

Everything is derived from the scanned tables, so the work grows with them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Fixed values of the PRED binding (multipliers of the score hash).
PRED_MODELS = 7
PRED_REPEATS = 20
PRED_HASH = (7919, 104729, 31, 15485863)
# Fixed values of the WIDE binding.
WIDE_GROUPS = 23
WIDE_NULL_MOD, WIDE_INF_MOD = 97, 211


ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def pred_scores(spark: SparkSession, sf_dir: str, row_key: bool = False) -> DataFrame:
    """PRED: every lineitem scored by 7 models; repeat = supplier mod 20.

    The 7 models are an ``explode`` of a literal array (a Generate node, no join).
    ``row_key`` keeps the lineitem columns that identify a scored row (with
    the supplier), for row-aligned operators such as the soft vote.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    m = F.col("m")
    w = F.lit(10) + F.lit(5) * m
    y = (F.col("l_quantity") > 35).cast("int")
    a, b, c, d = PRED_HASH
    h = (F.col("l_orderkey") * a + F.col("l_linenumber").cast("bigint") * b
         + F.col("l_partkey") * c + m.cast("bigint") * d) % 1000
    noise = F.floor(((F.lit(100) - w).cast("bigint") * h).cast("double") / F.lit(100.0))
    proba = (w.cast("bigint") * 10 * y + noise).cast("bigint").cast("double") / F.lit(1000.0)
    return (li.withColumn("m", F.explode(F.array(*[F.lit(i) for i in range(1, PRED_MODELS + 1)])))
            .select(F.concat(F.lit("M"), m.cast("string")).alias("model"),
                    (F.col("l_suppkey") % PRED_REPEATS).cast("int").alias("repeat"),
                    F.col("l_suppkey").alias("group_id"),
                    y.alias("y_true"),
                    proba.alias("proba"),
                    *([F.col(c) for c in ROW_KEY] if row_key else [])))


def _wide_value(vec_id, j, raw):
    return (F.when((vec_id * 31 + j) % WIDE_NULL_MOD == 0, F.lit(None).cast("double"))
            .when((vec_id * 17 + j) % WIDE_INF_MOD == 0, F.lit(float("inf")))
            .otherwise(raw.cast("double")))


def wide_samples(spark: SparkSession, sf_dir: str, derived: bool = False) -> DataFrame:
    """WIDE in row form: ``features array<double>`` with planted NULL and +inf.

    ``derived=True`` appends features 65..69 (2·f1+0.001·f2, 1, 0.5·f3,
    f1+0.25·f2, f1+0.25·f2+0.28·f4; NULL if an input is missing or infinite)
    so the variance and correlation filters have work to do.
    """
    emb = read_table(spark, sf_dir, "embeddings")
    vid = F.col("vec_id")
    pos = F.col("label") < 3
    feats = F.transform("embedding", lambda x, i: _wide_value(vid, i + 1, x))
    base = emb.select(
        vid.alias("row_id"),
        pos.cast("int").alias("label"),
        F.concat(F.when(pos, F.lit("P_")).otherwise(F.lit("N_")), (vid % WIDE_GROUPS).cast("string")).alias("patient_id"),
        F.when(F.expr(f"vec_id div {WIDE_GROUPS}") % 2 == 0, F.lit("Right")).otherwise(F.lit("Left")).alias("side"),
        feats.alias("features"))
    if not derived:
        return base

    def fin(k):
        v = F.col("features")[k - 1]
        return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(v)

    f1, f2, f3, f4 = fin(1), fin(2), fin(3), fin(4)
    extra = F.array(F.lit(2.0) * f1 + F.lit(0.001) * f2, F.lit(1.0), F.lit(0.5) * f3,
                    f1 + F.lit(0.25) * f2, f1 + F.lit(0.25) * f2 + F.lit(0.28) * f4)
    return base.withColumn("features", F.concat("features", extra))


def wide_long(spark: SparkSession, sf_dir: str, derived: bool = False) -> DataFrame:
    """WIDE long view ``(row_id, label, patient_id, side, feature_idx, value)``."""
    return (wide_samples(spark, sf_dir, derived)
            .select("row_id", "label", "patient_id", "side",
                    F.posexplode("features").alias("pos", "value"))
            .select("row_id", "label", "patient_id", "side",
                    (F.col("pos") + 1).alias("feature_idx"), "value"))


def groups_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GROUPS_TALL: lineitem rows grouped by supplier, label ``l_quantity > 35``."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("group_id"),
        (F.col("l_quantity") > 35).cast("int").alias("label"))


def mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIXED: events grouped by user, label ``event_type = 'purchase'``."""
    return read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("group_id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"))


def doc_samples(spark: SparkSession, sf_dir: str, target: str = "toxic") -> DataFrame:
    """DOCS: labelled documents grouped by source with whole-text count features."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col(target).alias("label"))
    t = F.col("text")
    feats = F.array(
        F.col("n_chars").cast("double"),
        F.size(F.split(t, r"\s+")).cast("double"),
        F.size(F.split(t, "\n")).cast("double"),
        (F.length(t) - F.length(F.regexp_replace(t, "[0-9]", ""))).cast("double"),
        (F.length(t) - F.length(F.regexp_replace(t, "[A-Z]", ""))).cast("double"),
        (F.length(t) - F.length(F.regexp_replace(t, "[!?.]", ""))).cast("double"))
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"), "label", F.col("source").alias("patient_id"),
        F.lit("none").alias("side"), feats.alias("features"))


def wide_feature_names(spark: SparkSession, derived: bool = False) -> DataFrame:
    """Feature-name dimension ``(feature_idx, feature_name)`` of WIDE (64 or 69
    rows; generated from the feature count, broadcast in lineage joins)."""
    n = 69 if derived else 64
    idx = F.col("id").cast("int")
    return spark.range(1, n + 1).select(
        idx.alias("feature_idx"),
        F.when(idx <= 64, F.concat(F.lit("Feature_"), F.lpad(idx.cast("string"), 4, "0")))
         .otherwise(F.concat(F.lit("Derived_"), idx.cast("string"))).alias("feature_name"))
