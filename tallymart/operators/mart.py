"""The star: one long fact, small dimensions, and projections per metric and dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.constants import DIMENSION_COLUMNS, PROJECTED_METRICS
from tallymart.functions import period_year
from tallymart.operators import geo
from tallymart.operators.spread import join_facts
from tallymart.session import local_frame

FACT_COLUMNS = (
    "metric_id", "geo_id", "period", "dimension", "category", "value",
    "reliability", "is_suppressed", "source_survey", "table_id", "updated_at",
)


@dataclass(frozen=True)
class Projection:
    name: str
    metric: str
    dimension: str
    category_column: str
    value_column: str


def projections() -> list[Projection]:
    """All published projections; names follow metric and dimension."""
    return [
        Projection(
            f"{metric.lower().replace(' ', '_')}_by_{DIMENSION_COLUMNS[dimension][0]}",
            metric, dimension, DIMENSION_COLUMNS[dimension][1], value_column,
        )
        for metric, (value_column, dimensions) in PROJECTED_METRICS.items()
        for dimension in dimensions
    ]


def is_suppressed(value: Column, reliability: Column) -> Column:
    return value.isNull() & reliability.isNull()


def null_reason(value: Column, reliability: Column) -> Column:
    """Finer than the flag: a withheld cell may still carry its quality code."""
    return (
        F.when(value.isNotNull(), "published")
        .when(reliability.isNull(), "withheld_no_code")
        .otherwise("withheld_with_code")
    )


def attach_metric(df: DataFrame, table_map: DataFrame) -> DataFrame:
    """Metric and dimension by table id; rows of other tables are dropped."""
    return df.join(table_map, "table_id")


def place_fact(observations: DataFrame, table_map: DataFrame, directory: DataFrame) -> DataFrame:
    """Observations -> rows of known places and metrics, with level, id and suppression flag."""
    # Metrics first: their map is tiny, so other tables' rows go before places are matched.
    measured = attach_metric(geo.with_resolved_place(observations), table_map)
    return geo.tag_level(measured, directory).withColumn(
        "is_suppressed", is_suppressed(F.col("value"), F.col("reliability"))
    )


def shape_fact(fact: DataFrame) -> DataFrame:
    return fact.withColumnRenamed("survey", "source_survey").select(*FACT_COLUMNS)


def dimension_values(fact: DataFrame) -> DataFrame:
    """(dimension, category) with a 1-based index over their global order.

    No window holds a whole dimension: the distinct labels are cut into ranges of
    (dimension, category), which splits a dimension holding most labels over many tasks;
    each range counts its labels per dimension, those few counts are summed along the
    ranges and the dimensions, and a label's index is its range's base plus its place in
    the range.
    """
    labels = fact.where(F.col("dimension").isNotNull()).select("dimension", "category").distinct()
    ranged = (
        labels.repartitionByRange("dimension", "category").sortWithinPartitions("dimension", "category")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    )
    counts = ranged.groupBy("part", "dimension").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    inside = Window.partitionBy("dimension").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("dimension").agg(F.sum("n").alias("size"))
    before = Window.orderBy("dimension").rowsBetween(Window.unboundedPreceding, -1)  # one row per dimension
    shifts = sizes.select("dimension", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    bases = counts.select("part", "dimension", "first", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("base")).join(shifts, "dimension")
    return ranged.join(bases, ["part", "dimension"]).select(
        "dimension", "category", (F.col("shift") + F.col("base") + F.col("at") - F.col("first") + 1).cast("smallint").alias("sort_order")
    )


def star(fact: DataFrame, metrics: DataFrame, geographies: DataFrame) -> DataFrame:
    """fact ⨝ metrics ⨝ geographies."""
    return join_facts(fact.join(metrics.drop("source_survey"), "metric_id"), geographies, ["geo_id"])


def project_metric(starred: DataFrame, spec: Projection) -> DataFrame:
    """One denormalised metric table from the joined star."""
    return starred.where((F.col("metric_name") == spec.metric) & (F.col("dimension") == spec.dimension)).select(
        "geo_level", "geo_name", "province", "cma", "period",
        period_year(F.col("period")).alias("period_year"),
        F.col("category").alias(spec.category_column),
        F.col("value").alias(spec.value_column),
        "reliability", "is_suppressed", "source_survey", "table_id", "updated_at",
    )


def tables_of(table_map: DataFrame, metrics: DataFrame, spec: Projection) -> DataFrame:
    """The publication tables of one projection, so that its fact holds nothing else."""
    named = metrics.where(F.col("metric_name") == spec.metric).select("metric_id")
    return table_map.where(F.col("dimension") == spec.dimension).join(named, "metric_id", "left_semi")


def projection_frame(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark, [(p.name, p.metric, p.dimension) for p in projections()],
        "table_name string, metric_name string, dimension string",
    )


def published_projections(fact: DataFrame, metrics: DataFrame) -> DataFrame:
    """Names and row counts of projections that have rows; one aggregate decides for all."""
    sizes = (
        fact.groupBy("metric_id", "dimension").agg(F.count(F.lit(1)).alias("n_rows"))
        .join(metrics.select("metric_id", "metric_name"), "metric_id")
    )
    return sizes.join(projection_frame(fact.sparkSession), ["metric_name", "dimension"]).select("table_name", "n_rows")


def all_projections(starred: DataFrame) -> DataFrame:
    """Rows of every projection in one pass, labelled by ``table_name``; empty ones have none."""
    named = starred.join(projection_frame(starred.sparkSession), ["metric_name", "dimension"])
    return named.select(
        "table_name", "geo_level", "geo_name", "province", "cma", "period",
        period_year(F.col("period")).alias("period_year"), "category", "value",
        "reliability", "is_suppressed", "source_survey", "table_id", "updated_at",
    )


def fact_gates() -> list[Column]:
    """Figures of a fact that its writing job counts as it goes (Spark's observed metrics)."""
    return [F.count(F.lit(1)).alias("n_observations"), F.count_if(F.col("is_suppressed")).alias("n_suppressed")]


def meta_row(fact: DataFrame, geographies: DataFrame, *, built_at: Column, source_newest: DataFrame,
             revision: str, coverage: str) -> DataFrame:
    """One row of build provenance.

    ``source_newest`` is a one-row (source_parquet_newest) frame over all clean files;
    ``coverage`` is a format string over n_cma, n_csd_with_data and n_csd_no_data.
    ``fact`` is either the fact or a one-row frame of n_observations and n_suppressed
    as the job that wrote the fact counted them (``fact_gates``).
    """
    rows = fact if set(fact.columns) == {"n_observations", "n_suppressed"} else fact.agg(*fact_gates())
    district = F.col("geo_level") == "CSD"
    places = geographies.agg(
        F.count_if(district & F.col("has_data")).alias("n_csd_with_data"),
        F.count_if(district & ~F.col("has_data")).alias("n_csd_no_data"),
        F.count_if(F.col("geo_level") == "CMA").alias("n_cma"),
    )
    # Three one-row aggregates stacked and folded into one row.
    stacked = rows.unionByName(places, allowMissingColumns=True).unionByName(source_newest, allowMissingColumns=True)
    one = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    return one.select(
        built_at.alias("built_at_utc"), "source_parquet_newest", F.lit(revision).alias("portal_commit"),
        "n_observations", "n_suppressed", "n_csd_with_data", "n_csd_no_data", "n_cma",
        F.format_string(coverage, "n_cma", "n_csd_with_data", "n_csd_no_data").alias("coverage_summary"),
    )


def unique_places(directory: DataFrame, province: Column) -> DataFrame:
    """Place attributes by id, one row each, so that no join on the id adds rows."""
    first = F.min(F.struct("geo_name", "geo_level", "cma", "csduid", "cma_uid")).alias("p")
    return directory.groupBy("geo_id").agg(first).select("geo_id", "p.*", province.alias("province"))


@dataclass(frozen=True)
class Mart:
    rental_observations: DataFrame
    metrics: DataFrame
    geographies: DataFrame
    dimension_values: DataFrame
    places: DataFrame

    def star(self) -> DataFrame:
        """Places come from reference frames, so the fact is computed once, not again for its places."""
        return star(self.rental_observations, self.metrics, self.places)

    def tables(self) -> dict[str, DataFrame]:
        """Core tables and every projection, by published name."""
        starred = self.star()
        core = {f: getattr(self, f) for f in ("rental_observations", "metrics", "geographies", "dimension_values")}
        return core | {p.name: project_metric(starred, p) for p in projections()}


def build_mart(observations: DataFrame, *, metrics: DataFrame, table_map: DataFrame, directory: DataFrame,
               province: Column) -> Mart:
    """Long observations -> star.

    The tables are lazy; to publish them all, ``sources.sinks.write_mart`` writes the
    fact first and reads it back for the rest.
    """
    fact = shape_fact(place_fact(observations, table_map, directory))
    places = geo.geography_dimension(fact, directory, province=province)
    return Mart(fact, metrics, places, dimension_values(fact), unique_places(directory, province))
