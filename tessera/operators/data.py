"""Sample loading and integrity checks: global group keys, class unions,
feature assembly (prefix selection, one-hot, concat), ±inf → missing,
and the pre-split integrity report."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import attach_scalar
from tessera.sources.tables import read_class_csv


def with_group_key(df: DataFrame, prefix: str, index_col: str = "PatientIndex",
                   out: str = "patient_id") -> DataFrame:
    """Global group key ``<prefix>_<index>`` (class files reuse indices)."""
    return df.withColumn(out, F.concat_ws("_", F.lit(prefix), F.col(index_col).cast("string")))


def union_sources(sources: Mapping[str, tuple[DataFrame, int]], index_col: str = "PatientIndex",
                  out: str = "patient_id") -> DataFrame:
    """P1 + P2 + U1: tag each class table with its prefixed key and constant
    label, then union by name (missing columns become NULL)."""
    parts = [with_group_key(df, prefix, index_col, out).withColumn("label", F.lit(label))
             for prefix, (df, label) in sources.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p, allowMissingColumns=True)
    return result


def load_samples(spark: SparkSession, sources: Mapping[str, tuple[str, int]],
                 index_col: str = "PatientIndex") -> DataFrame:
    """One CSV per class → the combined sample table."""
    return union_sources({p: (read_class_csv(spark, path), lab) for p, (path, lab) in sources.items()},
                         index_col)


def feature_array(df: DataFrame, prefix: str = "Feature_", out: str = "features") -> tuple[DataFrame, list[str]]:
    """P3 + P7: columns whose name starts with ``prefix`` → one array<double>;
    returns the names in order (the feature-name dimension)."""
    names = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in names])), names


def one_hot(df: DataFrame, column: str, categories: Sequence[str] | None = None,
            prefix: str | None = None) -> tuple[DataFrame, list[str]]:
    """Int 0/1 indicator per category in sorted order; NULL → all zeros.
    Categories are read once from the (small) distinct set when not given."""
    if categories is None:
        categories = sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)
    prefix = prefix or column
    names = [f"{prefix}_{c}" for c in categories]
    cols = [F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0)).alias(n)
            for c, n in zip(categories, names)]
    return df.select("*", *cols), names


def assemble(df: DataFrame, blocks: Sequence[str | Sequence[str]], out: str = "features") -> DataFrame:
    """P5: column-wise concat of array columns and scalar columns in one select."""
    parts = []
    for b in blocks:
        if isinstance(b, str):
            parts.append(F.col(b).cast("array<double>"))
        else:
            parts.append(F.array(*[F.col(c).cast("double") for c in b]))
    return df.withColumn(out, F.concat(*parts))


def inf_to_null(df: DataFrame, features: str = "features") -> DataFrame:
    """±inf and NaN in the feature array become NULL (missing); adds the
    per-row count of replaced values in ``n_nonfinite``."""
    bad = lambda v: F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return (df.withColumn("n_nonfinite", F.size(F.filter(features, lambda v: v.isNotNull() & bad(v))))
              .withColumn(features, F.transform(features, lambda v: F.when(bad(v), F.lit(None).cast("double"))
                                                .otherwise(v))))


def label_overlap(df: DataFrame, group: str = "patient_id", label: str = "label") -> DataFrame:
    """Group keys that occur under more than one class."""
    g0 = df.filter(F.col(label) == 0).select(group)
    g1 = df.filter(F.col(label) == 1).select(group)
    return g0.intersect(g1)


def mixed_label_groups(df: DataFrame, group: str = "patient_id", label: str = "label") -> DataFrame:
    """A1: groups with more than one distinct label (violations)."""
    return (df.groupBy(group).agg(F.countDistinct(label).alias("n_labels"))
            .filter(F.col("n_labels") > 1))


def group_sizes(df: DataFrame, group: str = "patient_id") -> DataFrame:
    """A2: rows per group."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))


def group_size_deviants(df: DataFrame, group: str = "patient_id") -> DataFrame:
    """A3 + A4: groups whose size differs from the modal size (smallest mode
    on ties); returns ``(group, n_rows, mode_size)``."""
    sizes = group_sizes(df, group)
    freq = sizes.groupBy("n_rows").agg(F.count(F.lit(1)).alias("f"))
    mode = freq.agg(F.min_by("n_rows", F.struct(-F.col("f"), F.col("n_rows"))).alias("mode_size"))
    return attach_scalar(sizes, mode).filter(F.col("n_rows") != F.col("mode_size"))


def class_distribution(df: DataFrame, group: str = "patient_id", label: str = "label") -> DataFrame:
    """A5 + P18: rows, share of rows in percent and distinct groups per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(group).alias("n_groups"))
    return c.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))


def integrity_report(df: DataFrame, group: str = "patient_id", label: str = "label") -> DataFrame:
    """All pre-split checks as rows ``(check, group, detail)``: class overlap and
    mixed-label groups are errors, size deviations are warnings."""
    ov = label_overlap(df, group, label).select(F.lit("class_overlap").alias("check"), F.col(group).alias("group"),
                                                 F.lit(None).cast("string").alias("detail"))
    mx = mixed_label_groups(df, group, label).select(F.lit("mixed_label").alias("check"), F.col(group).alias("group"),
                                                     F.col("n_labels").cast("string").alias("detail"))
    dv = group_size_deviants(df, group).select(
        F.lit("size_deviation").alias("check"), F.col(group).alias("group"),
        F.concat_ws("/", F.col("n_rows").cast("string"), F.col("mode_size").cast("string")).alias("detail"))
    return ov.unionByName(mx).unionByName(dv)
