"""Latency quantiles of the run log from mergeable sketches, kept per day and outcome.

Each day's attempts become one KLL sketch per outcome (Spark's own ``kll_sketch_agg_double``,
``k`` = ``K``): a few kilobytes whatever the number of attempts.  Sketches are stored in a
folder per day, and a day processed again replaces its folder, so a re-run never counts
twice.  Quantiles over any span of days merge the stored sketches, never the attempts; the
rank of a returned value is within about 1.7 % of the asked rank at ``K`` = 200 (the
sketch's normalized rank error), counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 200
QUANTILES = (0.5, 0.9, 0.99)


def day_sketches(log: DataFrame, k: int = K) -> DataFrame:
    """(day, outcome, n, sketch) of a run log (ts, outcome, latency_s); rows without a latency or time are left out."""
    timed = log.where(F.col("latency_s").isNotNull() & F.col("ts").isNotNull())
    return timed.groupBy(F.to_date("ts").alias("day"), "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col("latency_s").cast("double"), k).alias("sketch"))


def store_days(sketches: DataFrame, path: str) -> None:
    """Write the sketches of the days at hand; other days' folders stay."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def quantiles(spark: SparkSession, path: str, qs: Sequence[float] = QUANTILES) -> DataFrame:
    """Per outcome over all stored days: n and one column per quantile (p50, p90, ...)."""
    stored = spark.read.parquet(path)
    merged = stored.groupBy("outcome").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(q)) for q in qs]))
    return merged.select("outcome", "n", *(values[i].alias(f"p{round(q * 100)}") for i, q in enumerate(qs)))
