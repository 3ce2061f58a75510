"""Group-aware repeated splits and folds as assignment tables.

Groups are ordered per repeat by ``md5(seed ':' repeat ':' group)`` (same text
in any SQL engine).  The position of a group in that order is computed in two
levels — count per (repeat, hash bucket), prefix the bucket counts, then
``row_number`` inside each bucket — so no single task sorts a whole repeat.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import DEFAULT_SEED

HASH_BUCKET_HEX = 3           # 16^3 = 4096 buckets per repeat


def hash_rank(df: DataFrame, part: Sequence[str], key: str, tie: str, out: str = "pos") -> DataFrame:
    """1-based position of each row in ``(key, tie)`` order within ``part``,
    plus the partition size ``part_n``; exact, computed bucket-parallel.
    ``key`` must be a lowercase hex digest (uniform buckets)."""
    part = list(part)
    b = F.conv(F.substring(F.col(key), 1, HASH_BUCKET_HEX), 16, 10).cast("int")
    d = df.withColumn("_hb", b)
    cnt = d.groupBy(*part, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*part).orderBy("_hb")
    offs = cnt.select(*part, "_hb",
                      (F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
                      F.sum("_c").over(Window.partitionBy(*part)).alias("part_n"))
    inner = Window.partitionBy(*part, "_hb").orderBy(key, tie)
    return (d.join(offs, [*part, "_hb"])
            .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.row_number().over(inner))
            .drop("_hb", "_off"))


def _repeats(groups: DataFrame, n_repeats: int) -> DataFrame:
    return groups.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))


def _key(seed: F.Column, group: str) -> F.Column:
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), F.col("repeat").cast("string"),
                          F.lit(":"), F.col(group).cast("string")))


def group_split(samples: DataFrame, group: str = "patient_id", n_repeats: int = 20,
                test_size: float = 0.20, val_size: float = 0.125,
                seed: int = DEFAULT_SEED) -> DataFrame:
    """G1 + G2: per repeat, whole groups go to test (first ceil(test·G) in
    seeded order), then validation (first ceil(val·rest) of the rest in the
    order seeded ``seed + repeat``), the remainder to train.

    Returns the assignment table ``(repeat, group, split)``; it is never
    materialised per repeat — join it to rows late, after projection."""
    groups = samples.select(group).distinct()
    g = _repeats(groups, n_repeats).withColumn("_k1", _key(F.lit(seed), group))
    g = hash_rank(g, ["repeat"], "_k1", group, "pos1")
    n_test = F.ceil(F.col("part_n") * F.lit(test_size))
    g = g.withColumn("is_test", F.col("pos1") <= n_test).drop("part_n", "_k1", "pos1")
    rest = g.filter(~F.col("is_test")).withColumn("_k2", _key(F.lit(seed) + F.col("repeat"), group))
    rest = hash_rank(rest, ["repeat"], "_k2", group, "pos2")
    n_val = F.ceil(F.col("part_n") * F.lit(val_size))
    rest = rest.select("repeat", group,
                       F.when(F.col("pos2") <= n_val, F.lit("val")).otherwise(F.lit("train")).alias("split"))
    test = g.filter("is_test").select("repeat", group, F.lit("test").alias("split"))
    return test.unionByName(rest)


def assign_rows(samples: DataFrame, assignments: DataFrame, group: str = "patient_id") -> DataFrame:
    """Rows × their split per repeat (the assignment table is small:
    groups × repeats; AQE broadcasts it once its runtime size is known)."""
    return samples.join(assignments, group)


def leakage_violations(assigned: DataFrame, group: str = "patient_id",
                       by: Sequence[str] = ("repeat",), split: str = "split") -> DataFrame:
    """Groups that appear in more than one split of the same cell."""
    return (assigned.groupBy(*by, group).agg(F.countDistinct(split).alias("n_splits"))
            .filter(F.col("n_splits") > 1))


def majority_label(samples: DataFrame, group: str = "patient_id", label: str = "label") -> DataFrame:
    """Per group: majority label (ties → the larger label) and size."""
    return samples.groupBy(group).agg(
        F.count(F.lit(1)).alias("size"),
        F.when(F.sum(F.col(label).cast("long")) * 2 >= F.count(F.lit(1)), F.lit(1)).otherwise(F.lit(0)).alias("stratum"))


def stratified_group_kfold(samples: DataFrame, assignments: DataFrame | None = None,
                           group: str = "patient_id", label: str = "label", k: int = 5,
                           seed: int = DEFAULT_SEED, n_repeats: int = 1,
                           split: str = "train") -> DataFrame:
    """K folds of whole groups, class-balanced: within each (repeat,
    majority-label stratum) groups are dealt round-robin in seeded md5 order,
    so per-stratum fold counts differ by at most one group.

    With ``assignments`` the folds are built inside each repeat's ``split``
    part (inner CV on the training groups); otherwise over all groups for
    ``n_repeats`` repeats.  Returns ``(repeat, group, fold)``."""
    strata = majority_label(samples, group, label)
    if assignments is not None:
        g = assignments.filter(F.col("split") == split).select("repeat", group).join(strata, group)
    else:
        g = _repeats(strata, n_repeats)
    g = g.withColumn("_k", _key(F.lit(seed), group))
    g = hash_rank(g, ["repeat", "stratum"], "_k", group, "pos")
    return g.select("repeat", group, ((F.col("pos") - 1) % k).cast("int").alias("fold"))


def fold_cells(folds: DataFrame, k: int, group: str = "patient_id") -> DataFrame:
    """Train/held-out role of every training group in every (repeat, fold)
    cell: ``(repeat, fold, group, role)`` with role 'fit' or 'held'."""
    fg = folds.select("repeat", group, F.col("fold").alias("own"))
    cells = fg.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return cells.select("repeat", "fold", group,
                        F.when(F.col("own") == F.col("fold"), F.lit("held")).otherwise(F.lit("fit")).alias("role"))
