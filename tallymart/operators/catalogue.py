"""The survey catalogue, the metric inventory and the published-page catalogue.

The catalogue is expanded by rule: series specs meet breakdown codes on a shared
code-set key (an equi-join), ids are concatenated, exceptions override by left join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.constants import DEFAULT_GEO_FILTER, METRICS, SECTION_LABELS, SUB_METRO_BREAKDOWNS, TIME_SERIES
from tallymart.functions import url_slug
from tallymart.session import frozen, local_frame

CATALOGUE_COLUMNS = ("survey", "series", "dimension", "breakdown", "table_id", "geo_filter", "filters")
FILTERS_TYPE = "map<string,array<string>>"

# Request filters by survey family.
_MARKETS = ["Homeowner", "Rental", "Condo", "Co-op", "All"]
_DWELLINGS = ["Single", "Semi-detached", "Row", "Apartment", "All"]
STARTS_FILTERS = {"dimension-18": _MARKETS, "dimension-1": _DWELLINGS}
RENTAL_FILTERS = {"dwelling_type_desc_en": ["Row / Apartment", "Row", "Apartment"]}
RENTAL_SEASONS = {"season": ["October", "April"]}
TENURE_FILTERS = {"Tenure": ["Total", "Renters", "Owners"]}

# Code set -> (breakdown, code).
BREAKDOWN_CODES = {
    "starts_all": (("Provinces", "2"), ("Centres", "3"), ("Survey Zones", "8"),
                   ("Census Subdivision", "9"), ("Neighbourhoods", "10"), ("Census Tracts", "11")),
    "starts_sub_metro": tuple(zip(SUB_METRO_BREAKDOWNS, ("6", "7", "8", "9"))),
    "rental_all": (("Provinces", "1"), ("Centres", "2"), ("Survey Zones", "3"),
                   ("Census Subdivision", "4"), ("Neighbourhoods", "5"), ("Census Tracts", "6")),
    "rental_two": (("Survey Zones", "3"), ("Census Subdivision", "4")),
    "census_three": (("Survey Zones", "3"), ("Neighbourhoods", "4"), ("Census Tracts", "5")),
}

# Fixed values: (series, series code, time-series code by dwelling, by market, code set).
STARTS_SERIES = (
    ("Starts", "1", "2", "16", "starts_all"),
    ("Completions", "2", "2", "16", "starts_all"),
    ("Under Construction", "3", "2", "9", "starts_all"),
    ("Length of Construction", "7", "2", "16", "starts_sub_metro"),
    ("Absorbed Units", "5", "2", "16", "starts_sub_metro"),
    ("Share absorbed at completion", "6", "2", None, "starts_sub_metro"),
    ("Unabsorbed Inventory", "4", "2", None, "starts_sub_metro"),
)
STARTS_DIMENSION_CODES = {"Dwelling Type": "1", "Intended Market": "4"}

# Fixed values: (series, dimension, dimension code, code set).
RENTAL_SERIES = (
    ("Vacancy Rate", "Bedroom Type", "1", "rental_all"),
    ("Vacancy Rate", "Year of Construction", "2", "rental_all"),
    ("Vacancy Rate", "Structure Size", "3", "rental_all"),
    ("Vacancy Rate", "Rent Ranges", "4", "rental_all"),
    ("Vacancy Rate", "Rent Quartiles", "33", "rental_two"),
    ("Availability Rate", "Bedroom Type", "6", "rental_all"),
    ("Availability Rate", "Year of Construction", "7", "rental_all"),
    ("Availability Rate", "Structure Size", "8", "rental_all"),
    ("Average Rent", "Bedroom Type", "11", "rental_all"),
    ("Average Rent", "Year of Construction", "13", "rental_all"),
    ("Average Rent", "Structure Size", "15", "rental_all"),
    ("Average Rent Change", "Bedroom Type", "12", "rental_all"),
    ("Median Rent", "Bedroom Type", "21", "rental_all"),
    ("Median Rent", "Year of Construction", "22", "rental_all"),
    ("Median Rent", "Structure Size", "23", "rental_all"),
    ("Rental Universe", "Bedroom Type", "26", "rental_all"),
    ("Rental Universe", "Year of Construction", "27", "rental_all"),
    ("Rental Universe", "Structure Size", "28", "rental_all"),
    ("Summary Statistics", None, "31", "rental_two"),
)

# Secondary-market tables (series, dimension, id), all time series.
SECONDARY_TABLES = (
    ("Condo Vacancy Rate", "Structure Size", "4.2.1"),
    ("Condo Average Rent", "Bedroom Type", "4.4.2"),
    ("Condo Universe", "Structure Size", "4.2.3"),
    ("Rental Condo Universe", "Structure Size", "4.2.4"),
    ("Percentage Condo used as Rental", "Structure Size", "4.2.5"),
    ("Other Secondary Rental Universe", "Dwelling Type", "4.6.1"),
    ("Other Secondary Rental Average Rent", "Dwelling Type", "4.6.2"),
)

# seniors' tables (series, dimension, snapshot id, time-series id).
SENIORS_TABLES = (
    ("Rental Housing Vacancy Rates", "Unit Type", "3.2.1", "3.8.1"),
    ("Spaces", "Unit Type", "3.3.1", "3.3.2"),
    ("Universe and Number of Residents", "Spaces and Residents", "3.1.2", "3.8.6"),
    ("Heavy Care Spaces", "Vacancy Rate and Average Rent", "3.4.1", "3.8.3"),
    ("Proportion of Standard Spaces", "Rent Range", "3.6.1", "3.6.2"),
)

# National aggregates: (series, dimension) -> {geo filter: id}.
NATIONAL_TABLES = {
    ("Starts", "Dwelling Type"): {"All": "5.7.2", "10k": "5.6.2", "50k": "1.2.1.5", "Metro": "1.2.1.4"},
    ("Starts", "Intended Market"): {"10k": "1.16.1.6", "50k": "1.16.1.5", "Metro": "1.16.1.4"},
    ("Completions", "Dwelling Type"): {"All": "5.11.2", "10k": "5.10.2", "50k": "1.2.2.5", "Metro": "1.2.2.4"},
    ("Completions", "Intended Market"): {"10k": "1.16.2.6", "50k": "1.16.2.5", "Metro": "1.16.2.4"},
    ("Under Construction", "Dwelling Type"): {"10k": "1.2.3.6", "50k": "1.2.3.5", "Metro": "1.2.3.4"},
    ("Under Construction", "Intended Market"): {"10k": "1.9.3.6", "50k": "1.16.3.5", "Metro": "1.16.3.4"},
}

# Census series (series, dimension, time-series id, id prefix of breakdowns, by tenure).
_MAINTAINER = "Age of Primary Household Maintainer"
CENSUS_SERIES = (
    ("Income", "Average and Median", "7.63", "7.62", True),
    ("Income", "Ranges", "6.60", "6.59", True),
    ("Dwelling value", "Average", "6.4", "6.3", False),
    ("Dwelling value", "Median", "6.6", "6.5", False),
    ("All Households", "Age of Population", "6.8", "6.7", False),
    ("65 and over", "Age of Population", "6.98", "6.97", False),
    ("All Households", _MAINTAINER, "6.12", "6.11", True),
    ("65 and over", _MAINTAINER, "7.3", "7.2", True),
    ("Mobility 5 of All Households", _MAINTAINER, "6.16", "6.15", True),
    ("Mobility 5 of 65 and over", _MAINTAINER, "7.7", "7.6", True),
    ("Mobility 1 of All Households", _MAINTAINER, "6.20", "6.19", True),
    ("Mobility 1 of 65 and over", _MAINTAINER, "7.11", "7.10", True),
)
# Core-need tables (dimension, id), all time series by tenure.
CORE_NEED_TABLES = (
    ("% of Households in Core Housing Need", "7.17"),
    ("Households in Core Housing Need", "7.15"),
    ("Households Tested For Core Housing Need", "6.96"),
)
# Ids that do not follow the time-series rule.
TIME_SERIES_ID_OVERRIDES = (("Scss", "Length of Construction", "Intended Market", TIME_SERIES, "1.2.8"),)

_SPEC_SCHEMA = (
    f"survey string, series string, dimension string, id_prefix string, code_set string, "
    f"breakdown string, geo_filter string, filters {FILTERS_TYPE}"
)


def _table_specs() -> list[tuple]:
    """One row per id prefix; rows with a code set fan out over its breakdowns."""
    specs: list[tuple] = []

    def listed(survey, series, dimension, prefix, code_set, filters):
        specs.append((survey, series, dimension, prefix, code_set, None, DEFAULT_GEO_FILTER, filters))

    def fixed(survey, series, dimension, table_id, filters, breakdown=TIME_SERIES, geo_filter=DEFAULT_GEO_FILTER):
        specs.append((survey, series, dimension, table_id, None, breakdown, geo_filter, filters))

    for series, code, by_dwelling, by_market, code_set in STARTS_SERIES:
        for dimension, time_code in (("Dwelling Type", by_dwelling), ("Intended Market", by_market)):
            if time_code is not None:
                prefix = f"1.{STARTS_DIMENSION_CODES[dimension]}.{code}"
                listed("Scss", series, dimension, prefix, code_set, STARTS_FILTERS)
                fixed("Scss", series, dimension, f"1.{time_code}.{code}", STARTS_FILTERS)
    for series, dimension, code, code_set in RENTAL_SERIES:
        listed("Rms", series, dimension, f"2.1.{code}", code_set, RENTAL_FILTERS)
        fixed("Rms", series, dimension, f"2.2.{code}", RENTAL_FILTERS | RENTAL_SEASONS)
    for series, dimension, table_id in SECONDARY_TABLES:
        fixed("Srms", series, dimension, table_id, {})
    for series, dimension, snapshot_id, time_id in SENIORS_TABLES:
        fixed("Seniors", series, dimension, snapshot_id, {}, breakdown="Snapshot")
        fixed("Seniors", series, dimension, time_id, {})
    for (series, dimension), ids in NATIONAL_TABLES.items():
        for geo_filter, table_id in ids.items():
            fixed("Scss", series, dimension, table_id, STARTS_FILTERS, geo_filter=geo_filter)
    for series, dimension, time_id, prefix, by_tenure in CENSUS_SERIES:
        filters = TENURE_FILTERS if by_tenure else {}
        fixed("Census", series, dimension, time_id, filters)
        listed("Census", series, dimension, prefix, "census_three", filters)
    for dimension, table_id in CORE_NEED_TABLES:
        fixed("Core Housing Need", "Housing Standards", dimension, table_id, TENURE_FILTERS)
    return specs


def expand_catalogue(specs: DataFrame, codes: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """``specs`` with a ``code_set`` fan out over ``codes`` (code_set, breakdown, code).

    ``overrides`` (survey, series, dimension, breakdown, table_id) replaces single ids
    of default-scope rows.
    """
    fanned = (
        specs.where(F.col("code_set").isNotNull())
        .drop("breakdown")
        .join(codes, "code_set")
        .withColumn("table_id", F.concat_ws(".", "id_prefix", "code"))
    )
    single = specs.where(F.col("code_set").isNull()).withColumn("table_id", F.col("id_prefix"))
    rows = fanned.select(*CATALOGUE_COLUMNS).unionByName(single.select(*CATALOGUE_COLUMNS))
    if overrides is None:
        return rows
    keys = ["survey", "series", "dimension", "breakdown"]
    better = overrides.select(*keys, F.col("table_id").alias("better_id"), F.lit(DEFAULT_GEO_FILTER).alias("geo_filter"))
    return (
        rows.join(better, [*keys, "geo_filter"], "left")
        .withColumn("table_id", F.coalesce("better_id", "table_id"))
        .select(*CATALOGUE_COLUMNS)
    )


def code_frame(spark: SparkSession) -> DataFrame:
    rows = [(name, b, c) for name, pairs in BREAKDOWN_CODES.items() for b, c in pairs]
    return local_frame(spark, rows, "code_set string, breakdown string, code string")


def survey_catalogue(spark: SparkSession) -> DataFrame:
    """The full catalogue of published tables: fixed content, so expanded once per session."""

    def expanded() -> DataFrame:
        specs = local_frame(spark, _table_specs(), _SPEC_SCHEMA)
        overrides = local_frame(
            spark, TIME_SERIES_ID_OVERRIDES,
            "survey string, series string, dimension string, breakdown string, table_id string",
        )
        return expand_catalogue(specs, code_frame(spark), overrides)

    return frozen(spark, "survey_catalogue", expanded)


def find_tables(catalogue: DataFrame, **wanted: str | None) -> DataFrame:
    """AND of the given fields; ``None`` means any."""
    allowed = {"survey", "series", "dimension", "breakdown", "geo_filter"}
    if unknown := set(wanted) - allowed:
        raise TypeError(f"unknown catalogue fields: {sorted(unknown)}")
    tests: list[Column] = [F.col(k) == v for k, v in wanted.items() if v is not None]
    return catalogue.where(reduce(and_, tests)) if tests else catalogue


# --- metric inventory -----------------------------------------------------------


def metric_inventory(spark: SparkSession) -> DataFrame:
    rows = [(i, *m) for i, m in enumerate(METRICS, start=1)]
    return local_frame(
        spark, rows,
        "metric_id smallint, survey string, series string, metric_name string, market string, unit string",
    )


def metric_dimension(inventory: DataFrame, catalogue: DataFrame, publisher: str) -> DataFrame:
    """One row per metric with the sorted ids of the tables that feed it ('' without any)."""
    ids = catalogue.groupBy("survey", "series").agg(
        F.array_join(F.array_sort(F.collect_set("table_id")), ", ").alias("source_table_ids")
    )
    return inventory.join(ids, ["survey", "series"], "left").select(
        "metric_id", "metric_name", "market", F.col("survey").alias("source_survey"), "unit",
        F.concat_ws(" ", "metric_name", F.lit("from"), F.lit(publisher), "survey").alias("description"),
        F.coalesce("source_table_ids", F.lit("")).alias("source_table_ids"),
    )


def table_metric_map(inventory: DataFrame, catalogue: DataFrame) -> DataFrame:
    """table_id -> (metric_id, dimension), unique on table_id."""
    return (
        catalogue.join(inventory, ["survey", "series"])
        .groupBy("table_id")
        .agg(F.max(F.struct("metric_id", "dimension")).alias("m"))
        .select("table_id", "m.metric_id", "m.dimension")
    )


# --- published pages ------------------------------------------------------------


def page_catalogue(raw: DataFrame) -> DataFrame:
    """Nested page catalogue (``tables`` array per row) -> one row per page with its first asset."""
    t, asset = F.col("t"), F.try_element_at(F.col("t.assets"), F.lit(1))
    labels = F.create_map(*(F.lit(x) for pair in SECTION_LABELS.items() for x in pair))
    return raw.select(F.explode("tables").alias("t")).select(
        url_slug(t["page_url"]).alias("table_id"),
        F.coalesce(F.try_element_at(labels, t["section"]), t["section"]).alias("survey"),
        t["section"].alias("section"), t["title"].alias("title"), t["page_url"].alias("page_url"),
        asset["url"].alias("asset_url"), asset["size_bytes"].alias("size_bytes"),
        asset["last_modified"].alias("last_modified"),
    )


def downloadable(pages: DataFrame) -> DataFrame:
    """Pages of a catalogue that have a file."""
    return pages.where(F.col("asset_url").isNotNull())


def asset_status(pages: DataFrame) -> DataFrame:
    """Per survey: pages, those with a file, those without, bytes to download."""
    has = F.col("asset_url").isNotNull()
    return pages.groupBy("survey").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(has).alias("n_downloadable"), F.count_if(~has).alias("n_missing"),
        F.sum(F.when(has, F.col("size_bytes"))).alias("n_bytes"),
    )


def pages_by_slug(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (slug, ...) with the page of each slug; ``known`` is false where there is none."""
    named = pages.withColumnRenamed("table_id", "slug").withColumn("known", F.lit(True))
    return wanted.join(named, "slug", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def fill_from_second_pass(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pages without assets take those of a second discovery pass; ``discovery`` records the origin."""
    later = second.select("page_url", F.col("assets").alias("later"))
    own, other = F.col("assets"), F.coalesce(F.col("later"), F.expr("slice(assets, 1, 0)"))
    return first.join(later, "page_url", "left").select(
        *(c for c in first.columns if c not in ("assets", "discovery")),
        F.when(F.size(own) > 0, own).otherwise(other).alias("assets"),
        F.when(F.size(own) > 0, "html").when(F.size(other) > 0, "render").alias("discovery"),
    )


def discovery_summary(pages: DataFrame) -> DataFrame:
    n = F.size("assets")
    return pages.agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if(n > 0).alias("n_with_files"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_files"),
        F.count_if(F.col("discovery") == "html").alias("n_html"),
        F.count_if(F.col("discovery") == "render").alias("n_render"),
    )
