"""Admission gates, coverage audits and build bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_key_gate(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Per table: number of repeated keys and whether it passes (none repeated)."""
    counts = df.groupBy(table, *keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.count_if(F.col("n") > 1)
    return counts.groupBy(table).agg(repeated.alias("n_repeated"), (repeated == 0).alias("passes"))


def null_category_gate(df: DataFrame, table: str) -> DataFrame:
    """Per table: number of categories without any value and whether it passes (none such)."""
    filled = df.groupBy(table, "category").agg(F.count("value").alias("n"))
    empty = F.count_if(F.col("n") == 0)
    return filled.groupBy(table).agg(empty.alias("n_empty"), (empty == 0).alias("passes"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that should be unique and are not."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def coverage_verdict(log: DataFrame, table: str) -> DataFrame:
    """Empty at every place: suspect the request.  Error at every place: a dead id."""
    outcome = F.col("outcome")
    return log.groupBy(table).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.when(F.bool_and(outcome == "empty"), "suspect_request")
        .when(F.bool_and(outcome == "error"), "dead_table")
        .otherwise("serving").alias("verdict"),
    )


def join_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys on both sides, matched, and missing from either side."""
    sides = (
        left.select(key).distinct().select(key, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(key).distinct().select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    has_l, has_r = F.col("l") == 1, F.col("r") == 1
    return sides.agg(
        F.count_if(has_l).alias("n_left"), F.count_if(has_r).alias("n_right"),
        F.count_if(has_l & has_r).alias("n_matched"),
        F.count_if(has_l & ~has_r).alias("n_left_only"), F.count_if(has_r & ~has_l).alias("n_right_only"),
    )


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def fully_suppressed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups without a single published value."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_values")
    ).where(F.col("n_values") == 0).drop("n_values")


def stale_tables(inputs: DataFrame, outputs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tables to rebuild: no output yet, or an input newer than it.

    ``inputs`` is (keys, modified) per file, ``outputs`` (keys, built) per file.
    """
    newest = inputs.groupBy(*keys).agg(F.max("modified").alias("modified"), F.count(F.lit(1)).alias("n_inputs"))
    # The newest output file: every part of one rebuild is written after its inputs.
    built = outputs.groupBy(*keys).agg(F.max("built").alias("built"))
    return newest.join(built, list(keys), "left").where(F.col("built").isNull() | (F.col("modified") > F.col("built")))


def build_status_counts(specs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Planned tables by build status; a planned table without a result is ``missing``."""
    status = F.coalesce("status", F.lit("missing")).alias("status")
    return specs.select(key).join(results.select(key, "status"), key, "left").groupBy(status).agg(
        F.count(F.lit(1)).alias("n")
    )
