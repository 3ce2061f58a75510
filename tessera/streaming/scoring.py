"""Scoring on a stream: a fitted calibration (per-cell Platt parameters) and
a per-cell decision threshold are small static tables, so they apply to a
streaming DataFrame with a stream–static join and column expressions only.

    scored = score_stream(spark.readStream.parquet(path), platt, thresholds, ["model"])
    scored.writeStream.format("parquet").option("checkpointLocation", ckpt).start(out)
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import clip01


def score_stream(stream: DataFrame, platt: DataFrame, thresholds: DataFrame, by: Sequence[str],
                 score: str = "score") -> DataFrame:
    """Calibrated probability and inclusive decision ``p >= t`` for each
    streamed row (works unchanged on a batch DataFrame)."""
    by = list(by)
    j = (stream.join(F.broadcast(platt.select(*by, "a", "b")), by)
         .join(F.broadcast(thresholds.select(*by, "threshold")), by))
    p = clip01(1.0 / (1.0 + F.exp(F.col("a") * F.col(score) + F.col("b"))))
    return j.withColumn("proba", p).withColumn("y_pred", (F.col("proba") >= F.col("threshold")).cast("int")) \
        .drop("a", "b")
