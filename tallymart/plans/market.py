"""The star and everything published from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import analytics, catalogue, geo, mart
from tallymart.plans import inputs
from tallymart.plans.inputs import FACT, GEOGRAPHIES
from tallymart.plans.registry import query
from tallymart.session import frozen
from tallymart.sources import bucketed

PUBLISHER = "Agency"
COVERAGE = "%d metros, %d districts with data, %d districts without"


def table_map(spark: SparkSession) -> DataFrame:
    return frozen(
        spark, "table_metric_map",
        lambda: catalogue.table_metric_map(catalogue.metric_inventory(spark), catalogue.survey_catalogue(spark)),
    )


def metric_table(spark: SparkSession) -> DataFrame:
    return frozen(
        spark, "metrics",
        lambda: catalogue.metric_dimension(catalogue.metric_inventory(spark), catalogue.survey_catalogue(spark), PUBLISHER),
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.place_directory(
        inputs.provinces(spark, sf_dir), inputs.metros(spark, sf_dir), inputs.members(spark, sf_dir),
        province_id=F.concat(F.lit("PR:"), "geo_name"),
    )


def market_mart(spark: SparkSession, sf_dir: str, spec: mart.Projection | None = None) -> mart.Mart:
    tables = table_map(spark) if spec is None else mart.tables_of(table_map(spark), metric_table(spark), spec)
    return mart.build_mart(
        inputs.market(spark, sf_dir), metrics=metric_table(spark), table_map=tables,
        directory=directory(spark, sf_dir), province=F.lit("Home"),
    )


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.place_fact(inputs.market(spark, sf_dir), table_map(spark), directory(spark, sf_dir))


_FACT_COLUMNS = "metric_id, geo_id, period, dimension, category, value, reliability, is_suppressed, source_survey, table_id, updated_at"


@query(f"WITH {FACT} SELECT {_FACT_COLUMNS} FROM fact")
def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations -> fact: resolved places, levels, metrics, suppression."""
    return market_mart(spark, sf_dir).rental_observations


@query(f"""WITH {GEOGRAPHIES} SELECT * FROM geographies""")
def geo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with data, and member districts without."""
    return market_mart(spark, sf_dir).geographies


@query(f"""WITH {FACT} SELECT geo_name, geo_level, count(*) AS n FROM fact GROUP BY 1, 2""")
def geo_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level tagging by reference membership; places of no known name are dropped."""
    known = inputs.market(spark, sf_dir).join(table_map(spark), "table_id", "left_semi")
    tagged = geo.tag_level(geo.with_resolved_place(known), directory(spark, sf_dir))
    return tagged.groupBy("geo_name", "geo_level").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {FACT} SELECT table_id, geo_name, geo_level, geo_id, period, category FROM fact")
def attach_geo_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by (name, level) from a geography table."""
    placed = _placed(spark, sf_dir).drop("geo_id")
    return geo.attach_geo_id(placed, directory(spark, sf_dir)).select(
        "table_id", "geo_name", "geo_level", "geo_id", "period", "category"
    )


_SIZES = FACT[: FACT.index(", grouped AS")]


@query(f"""WITH {_SIZES} SELECT table_id, CAST(metric_id AS SMALLINT) AS metric_id, dimension, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN sizes USING (p_size) WHERE metric_id IS NOT NULL GROUP BY 1, 2, 3""")
def attach_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric and dimension by table id; rows of other tables are dropped."""
    lines = inputs.table(spark, sf_dir, "lineitem").join(
        inputs.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).join(inputs.table_sizes(spark), "p_size")
    return mart.attach_metric(lines, table_map(spark)).groupBy("table_id", "metric_id", "dimension").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(f"""WITH {_SIZES}, used AS (SELECT DISTINCT p_size FROM part)
SELECT CAST(metric_id AS SMALLINT) AS metric_id, string_agg(table_id, ', ' ORDER BY table_id) AS source_table_ids
FROM sizes JOIN used USING (p_size) WHERE metric_id IS NOT NULL GROUP BY 1""")
def metric_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric -> sorted ids of the tables the data was published under."""
    used = inputs.table_sizes(spark).join(inputs.table(spark, sf_dir, "part"), "p_size", "left_semi")
    published = catalogue.survey_catalogue(spark).join(used, "table_id", "left_semi")
    dimension = catalogue.metric_dimension(catalogue.metric_inventory(spark), published, PUBLISHER)
    return dimension.where(F.col("source_table_ids") != "").select("metric_id", "source_table_ids")


@query(f"""WITH {GEOGRAPHIES}, m(metric_id, metric_name, market) AS (VALUES {', '.join(str((i, n, k)) for i, (_, _, n, k, _) in enumerate(inputs.METRICS, 1))})
SELECT geo_name, period, metric_name, market, dimension, category, value FROM fact f JOIN m USING (metric_id) JOIN geographies g USING (geo_id)
WHERE metric_name IN ('Vacancy Rate', 'Average Rent') AND dimension = 'Bedroom Type'""".replace("geo_name, period, metric_name", "g.geo_name, period, metric_name"))
def star_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact ⨝ metrics ⨝ geographies."""
    return market_mart(spark, sf_dir).star().where(
        F.col("metric_name").isin("Vacancy Rate", "Average Rent") & (F.col("dimension") == "Bedroom Type")
    ).select("geo_name", "period", "metric_name", "market", "dimension", "category", "value")


@query(f"""WITH {FACT}, d AS (SELECT DISTINCT dimension, category FROM fact WHERE dimension IS NOT NULL)
SELECT dimension, category, CAST(row_number() OVER (ORDER BY dimension, category) AS SMALLINT) AS sort_order FROM d""")
def dimension_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_mart(spark, sf_dir).dimension_values


@query(f"""WITH {GEOGRAPHIES}, f AS (SELECT count(*) AS n, count(*) FILTER (is_suppressed) AS s FROM fact),
 g AS (SELECT count(*) FILTER (geo_level = 'CSD' AND has_data) AS w, count(*) FILTER (geo_level = 'CSD' AND NOT has_data) AS wo,
              count(*) FILTER (geo_level = 'CMA') AS c FROM geographies)
SELECT (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) AS source_parquet_newest, 'rev' AS portal_commit, n AS n_observations, s AS n_suppressed,
  w AS n_csd_with_data, wo AS n_csd_no_data, c AS n_cma,
  c || ' metros, ' || w || ' districts with data, ' || wo || ' districts without' AS coverage_summary FROM f, g""")
def meta_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build provenance; the newest ship date stands for the newest file."""
    built = market_mart(spark, sf_dir)
    newest = inputs.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("date").alias("source_parquet_newest"))
    return mart.meta_row(
        built.rental_observations, built.geographies, built_at=F.current_timestamp(), source_newest=newest,
        revision="rev", coverage=COVERAGE,
    ).drop("built_at_utc")


_NAMES = ", ".join(
    str((p.name, i, p.dimension))
    for p in mart.projections()
    for i, m in enumerate(inputs.METRICS, start=1) if m[2] == p.metric
)


@query(f"""WITH {FACT}, names(table_name, metric_id, dimension) AS (VALUES {_NAMES})
SELECT table_name, count(*) AS n_rows FROM fact JOIN names USING (metric_id, dimension) GROUP BY 1""")
def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projections with rows; empty ones are not published."""
    built = market_mart(spark, sf_dir)
    return mart.published_projections(built.rental_observations, built.metrics)


def _metric_table(spec: mart.Projection):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart.project_metric(market_mart(spark, sf_dir, spec).star(), spec)

    run.__doc__ = f"{spec.metric} by {spec.dimension}."
    return run


for _spec in mart.projections():
    _id = next(i for i, m in enumerate(inputs.METRICS, start=1) if m[2] == _spec.metric)
    query(
        f"""WITH {GEOGRAPHIES} SELECT g.geo_level, g.geo_name, g.province, g.cma, period, CAST(year(period) AS SMALLINT) AS period_year,
  category AS {_spec.category_column}, value AS {_spec.value_column}, reliability, is_suppressed, source_survey, table_id, updated_at
FROM fact f JOIN geographies g USING (geo_id) WHERE metric_id = {_id} AND dimension = '{_spec.dimension}'""",
        name=f"metric_table_{_spec.name}",
    )(_metric_table(_spec))


@query(f"""WITH {GEOGRAPHIES}, r AS (SELECT *, row_number() OVER (PARTITION BY geo_id, metric_id, dimension, category, table_id ORDER BY period DESC) AS rn FROM fact)
SELECT r.geo_id, g.geo_name, metric_id, dimension, category, table_id, period, value FROM r JOIN geographies g ON r.geo_id = g.geo_id WHERE rn = 1""")
def bucketed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place's newest value per metric and category, over the star stored in buckets of geo_id."""
    built = market_mart(spark, sf_dir)
    stored = bucketed.store(built.rental_observations, lambda fact: geo.geography_dimension(fact, directory(spark, sf_dir), province=F.lit("Home")))
    keys = ["geo_id", "metric_id", "dimension", "category", "table_id"]
    return bucketed.latest(spark, stored, keys, ["value"], place_columns=["geo_name"]).select(
        "geo_id", "geo_name", "metric_id", "dimension", "category", "table_id", "period", "value")
