"""Analyst queries over long observations and metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import period_year, round_to_int
from tallymart.operators.spread import join_facts


def latest_per_group(df: DataFrame, keys: Sequence[str], values: Sequence[str], *,
                     period: str = "period", ties: Sequence[str] = ()) -> DataFrame:
    """Values of each group's newest row; a suppressed newest row stays null.

    A partial aggregate of one struct: map tasks send one row per group, so a group
    holding most rows costs no more than any other.  Null periods sort first, hence
    lose to any date.
    """
    columns = list(dict.fromkeys([period, *ties, *values]))
    newest = F.max(F.struct(*columns)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *(F.col(f"newest.{c}").alias(c) for c in [period, *values]))


def dedup_paths(df: DataFrame, keys: Sequence[str], path: str = "table_id") -> DataFrame:
    """One row per logical observation: that of the smallest publication path.

    Equal to keeping row_number() = 1 over (keys, path order), as a partial aggregate.
    """
    rest = [c for c in df.columns if c not in keys and c != path]
    first = F.min(F.struct(path, *rest)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, *(F.col(f"first.{c}").alias(c) for c in rest))


def rows_per_survey(df: DataFrame) -> DataFrame:
    return df.groupBy("survey").agg(F.count(F.lit(1)).alias("n_rows"))


def annual_totals(df: DataFrame, years: int = 8) -> DataFrame:
    """Sums of sub-annual readings by year, the newest years first."""
    year = period_year(F.col("period")).alias("year")
    total = round_to_int(F.sum("value")).alias("total")
    return df.groupBy(year).agg(total).orderBy(F.desc("year")).limit(years)


def count_by_code(df: DataFrame) -> DataFrame:
    return df.where(F.col("value").isNotNull()).groupBy("reliability").agg(F.count(F.lit(1)).alias("n"))


def freshness(df: DataFrame, stamp: str) -> DataFrame:
    return df.agg(F.max(stamp).alias("freshest"), F.min(stamp).alias("stalest"))


def distinct_names(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).select(name).distinct().orderBy(name)


def top_values(df: DataFrame, value: str, ties: Sequence[str], limit: int = 10) -> DataFrame:
    """Largest published values; ties are broken by key so that the cut is stable."""
    return df.where(F.col(value).isNotNull()).orderBy(F.desc(value), *ties).limit(limit)


def published_series(df: DataFrame, place: str, names: Sequence[str], category: str) -> DataFrame:
    """Rows a line chart draws: chosen places, one category, published values."""
    return df.where(F.col(place).isin(*names) & (F.col("category") == category) & F.col("value").isNotNull())


def high_confidence(df: DataFrame, codes: Sequence[str] = ("a", "b")) -> DataFrame:
    return df.where(F.col("reliability").isin(*codes))


def compare_markets(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], value: str,
                    names: tuple[str, str]) -> DataFrame:
    """Primary readings beside secondary ones; both sides are one row per key before the join."""
    left = dedup_paths(primary.select(*keys, "table_id", F.col(value).alias(names[0])), keys)
    right = dedup_paths(secondary.select(*keys, "table_id", F.col(value).alias(names[1])), keys)
    return left.join(right, list(keys), "left")


def members_by_value(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Distinct members of each group, each with the group's size.

    One row per member: a group is never gathered into one array, so it may be of
    any size.
    """
    distinct = df.select(*keys, member).distinct()
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_members"))
    return join_facts(distinct, sizes, keys)


def outcomes_by(df: DataFrame, key: str, outcome: str) -> DataFrame:
    """Rows with one outcome, counted per key."""
    return df.where(F.col("outcome") == outcome).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def latency_by_outcome(df: DataFrame, latency: Column) -> DataFrame:
    """Attempts, mean and worst latency per outcome; the mean is exact on the given unit."""
    return df.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(latency).cast("double") / F.count(latency)).alias("avg_latency"),
        F.max(latency).cast("double").alias("max_latency"),
    )
