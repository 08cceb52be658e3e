"""Planning of (table, place) requests, and diagnosis from their outcomes.

Whether a table fits a place depends only on the place's class.  Each table lists
the classes it is valid for and meets places by equi-join on that class, so no
invalid pair is ever produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.constants import (
    DEAD_TABLE_IDS,
    DEFAULT_GEO_FILTER,
    LEVEL_COUNTRY,
    LEVEL_DISTRICT,
    LEVEL_METRO,
    LEVEL_PROVINCE,
    LEVEL_TRACT,
    METRO_SCOPED_BREAKDOWNS,
    NATIONAL_GEO_FILTERS,
    PARENT_BREAKDOWNS,
    SUB_METRO_BREAKDOWNS,
)


def place_classes(places: DataFrame, members: DataFrame, listed_provinces: DataFrame) -> DataFrame:
    """Add ``place_class`` to (geography_id, level, province_code, ...).

    A district is ``outside`` only when its province's member list is known and
    lacks it; unknown provinces are treated as inside.
    """
    inside = members.select(F.col("geography_id").alias("member_id")).distinct()
    known = listed_provinces.select(F.col("province_code").alias("known_province")).distinct()
    flagged = places.join(inside, F.col("geography_id") == F.col("member_id"), "left").join(
        known, F.col("province_code") == F.col("known_province"), "left"
    )
    outside = F.col("known_province").isNotNull() & F.col("member_id").isNull()
    return flagged.withColumn(
        "place_class",
        F.when(F.col("level") == LEVEL_COUNTRY, "country")
        .when(F.col("level") == LEVEL_PROVINCE, "province")
        .when(F.col("level") == LEVEL_METRO, "metro")
        .when((F.col("level") == LEVEL_DISTRICT) & outside, "district_outside")
        .when(F.col("level") == LEVEL_DISTRICT, "district")
        .when(F.col("level") == LEVEL_TRACT, "tract"),
    ).drop("member_id", "known_province")


def valid_classes(table_id: Column, breakdown: Column, geo_filter: Column) -> Column:
    """Classes of places a table can be asked for."""
    parent = breakdown.isin(*PARENT_BREAKDOWNS)
    sub_metro = breakdown.isin(*SUB_METRO_BREAKDOWNS)
    default = geo_filter == DEFAULT_GEO_FILTER
    rules = {
        "country": ~sub_metro & (parent | geo_filter.isin(*NATIONAL_GEO_FILTERS)),
        "province": (breakdown == "Centres") & default,
        "metro": ~parent & ~sub_metro & default,
        "district": ~parent & default,
        "district_outside": ~parent & ~breakdown.isin(*METRO_SCOPED_BREAKDOWNS) & default,
        "tract": ~parent & default,
    }
    alive = ~table_id.isin(*DEAD_TABLE_IDS)
    return F.array_compact(F.array(*(F.when(alive & rule, F.lit(name)) for name, rule in rules.items())))


def valid_jobs(catalogue: DataFrame, classified: DataFrame, surveys: list[str] | None = None) -> DataFrame:
    """Every (table, place) worth asking for."""
    chosen = catalogue if surveys is None else catalogue.where(F.col("survey").isin(*surveys))
    tables = chosen.select(
        "survey", "table_id",
        F.explode(valid_classes(F.col("table_id"), F.col("breakdown"), F.col("geo_filter"))).alias("place_class"),
    )
    return classified.join(tables, "place_class")


def pending_jobs(jobs: DataFrame, done: DataFrame, empties: DataFrame, keys: list[str],
                 empty_since: Column | None = None) -> DataFrame:
    """Jobs not done and not known empty; markers failing ``empty_since`` no longer count."""
    fresh = empties if empty_since is None else empties.where(empty_since)
    return jobs.join(done.select(*keys), keys, "left_anti").join(fresh.select(*keys), keys, "left_anti")


def filter_variants(catalogue: DataFrame) -> DataFrame:
    """Request variants of each table: bare, all filters, and all minus each single one."""
    filters = F.col("filters")
    none = F.map_filter(filters, lambda k, v: F.lit(False))
    bare = F.array(F.struct(F.lit("bare").alias("variant"), F.lit(None).cast("string").alias("removed"), none.alias("applied")))
    full = F.array(F.struct(F.lit("all").alias("variant"), F.lit(None).cast("string").alias("removed"), filters.alias("applied")))
    minus = F.transform(
        F.map_keys(filters),
        lambda k: F.struct(
            F.lit("minus").alias("variant"), k.alias("removed"),
            F.map_filter(filters, lambda name, v: name != k).alias("applied"),
        ),
    )
    some = F.cardinality(filters) > 0
    return catalogue.select(
        "survey", "table_id", F.inline(F.when(some, F.concat(bare, full, minus)).otherwise(bare))
    )


def diagnose_filters(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variant, removed, outcome) -> one verdict per key with the filters at fault."""
    ok = F.col("outcome") == "ok"
    flags = outcomes.groupBy(*keys).agg(
        F.coalesce(F.bool_or(F.when(F.col("variant") == "bare", ok)), F.lit(False)).alias("bare_ok"),
        F.coalesce(F.bool_or(F.when(F.col("variant") == "all", ok)), F.lit(False)).alias("all_ok"),
    )
    # Filters are listed for broken requests only; the flags of all keys are a plain hash aggregate.
    broken_keys = flags.where(F.col("bare_ok") & ~F.col("all_ok")).select(*keys)
    removed = outcomes.where((F.col("variant") == "minus") & ok & F.col("removed").isNotNull()).join(broken_keys, keys, "left_semi")
    recovering = removed.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("removed")), ", ").alias("recovering"))
    facts = flags.join(recovering, keys, "left").withColumn("recovering", F.coalesce("recovering", F.lit("")))
    broken = F.col("bare_ok") & ~F.col("all_ok")
    return facts.select(
        *keys,
        F.when(broken & (F.col("recovering") != ""), "filter_breaks_request")
        .when(broken, "no_single_filter_recovers")
        .when(~F.col("bare_ok"), "bare_request_fails")
        .otherwise("filters_work").alias("verdict"),
        F.when(broken, F.col("recovering")).otherwise("").alias("culprits"),
    )
