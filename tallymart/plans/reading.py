"""Analyst queries: latest values, totals, rankings, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import analytics, quality
from tallymart.plans import inputs
from tallymart.plans.inputs import CELLS, OBS, OBS_MULTI
from tallymart.plans.registry import query


@query(f"""WITH {OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY sub_geography, category ORDER BY period DESC) AS rn FROM obs)
SELECT sub_geography, category, period, value, reliability, geography FROM r WHERE rn = 1""")
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place's own newest reading per category; a suppressed one stays null."""
    return analytics.latest_per_group(
        inputs.obs(spark, sf_dir), ["sub_geography", "category"], ["value", "reliability", "geography"]
    )


@query(f"""WITH {OBS_MULTI}, r AS (SELECT *, row_number() OVER (PARTITION BY geography, sub_geography, period, category ORDER BY table_id) AS rn
  FROM obs_multi) SELECT survey, province, geography, sub_geography, period, category, value, reliability FROM r WHERE rn = 1""")
def dedup_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per logical observation across publication paths."""
    return analytics.dedup_paths(inputs.obs_multi(spark, sf_dir), ["geography", "sub_geography", "period", "category"])


@query(f"""WITH {OBS}, {OBS.replace('obs AS', 'again AS', 1)} SELECT 'Rms' AS survey, count(*) AS n_rows FROM obs
UNION ALL SELECT 'Scss', count(*) FROM again WHERE value IS NOT NULL""")
def rows_per_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two surveys in one frame, one aggregate."""
    survey = F.explode(F.when(F.col("value").isNotNull(), F.array(F.lit("Rms"), F.lit("Scss"))).otherwise(F.array(F.lit("Rms"))))
    return analytics.rows_per_survey(inputs.obs(spark, sf_dir).withColumn("survey", survey))


@query("""SELECT CAST(year(o_orderdate) AS SMALLINT) AS year, CAST(round_even(sum(CAST(o_totalprice AS DECIMAL(18, 2))) / 1000, 0) AS INTEGER) AS total
FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 8""".replace("round_even(sum(CAST(o_totalprice AS DECIMAL(18, 2))) / 1000, 0)",
    "round_even(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100000, 0)"))
def annual_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest years first, sub-annual readings summed."""
    quarterly = (
        inputs.table(spark, sf_dir, "orders")
        .groupBy(inputs.quarter(F.col("o_orderdate")).alias("period"))
        .agg((F.sum(inputs.cents(F.col("o_totalprice"))) / 100).cast("decimal(20,2)").alias("amount"))
    )
    return analytics.annual_totals(quarterly.select("period", (F.col("amount") / 1000).alias("value")))


@query(f"WITH {OBS} SELECT reliability, count(*) AS n FROM obs WHERE value IS NOT NULL GROUP BY 1")
def count_by_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.count_by_code(inputs.obs(spark, sf_dir))


@query("SELECT CAST(max(ts) AS VARCHAR) AS freshest, CAST(min(ts) AS VARCHAR) AS stalest FROM events")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.freshness(inputs.table(spark, sf_dir, "events"), "ts")
    return found.select(F.col("freshest").cast("string").alias("freshest"), F.col("stalest").cast("string").alias("stalest"))


@query(f"WITH {OBS} SELECT DISTINCT sub_geography FROM obs WHERE sub_geography IS NOT NULL ORDER BY 1")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distinct_names(inputs.obs(spark, sf_dir), "sub_geography")


@query(f"""WITH {OBS} SELECT sub_geography, period, category, value, reliability FROM obs WHERE value IS NOT NULL
ORDER BY value DESC, sub_geography, period, category LIMIT 10""")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_values(inputs.obs(spark, sf_dir), "value", ["sub_geography", "period", "category"]).select(
        "sub_geography", "period", "category", "value", "reliability"
    )


@query(f"""WITH {OBS}, latest AS (SELECT *, row_number() OVER (PARTITION BY sub_geography, category ORDER BY period DESC) AS rn FROM obs)
SELECT sub_geography, category, value, reliability FROM latest WHERE rn = 1 ORDER BY value DESC NULLS LAST, sub_geography, category""")
def sort_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full ranking of the latest readings, suppressed ones at the end."""
    return latest_per_group(spark, sf_dir).select("sub_geography", "category", "value", "reliability").orderBy(
        F.col("value").desc_nulls_last(), "sub_geography", "category"
    )


@query(f"""WITH {OBS} SELECT sub_geography, period, category, value FROM obs WHERE reliability IN ('a', 'b') AND year(period) = 2000
ORDER BY value DESC, sub_geography, period, category""")
def high_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking of one year's confident readings."""
    year = F.year("period") == 2000
    return analytics.high_confidence(inputs.obs(spark, sf_dir).where(year)).select(
        "sub_geography", "period", "category", "value"
    ).orderBy(F.desc("value"), "sub_geography", "period", "category")


@query(f"""WITH {OBS} SELECT sub_geography, period, value, reliability, value IS NULL AND reliability IS NULL AS is_suppressed
FROM obs WHERE category = 'RO' ORDER BY sub_geography, period""")
def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category over time, suppressed quarters marked."""
    suppressed = F.col("value").isNull() & F.col("reliability").isNull()
    return inputs.obs(spark, sf_dir).where(F.col("category") == "RO").select(
        "sub_geography", "period", "value", "reliability", suppressed.alias("is_suppressed")
    ).orderBy("sub_geography", "period")


@query(f"""WITH {OBS} SELECT sub_geography, period, category FROM obs WHERE value IS NULL AND reliability IS NULL
ORDER BY sub_geography, period, category LIMIT 100""")
def suppressed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.obs(spark, sf_dir).where(F.col("value").isNull() & F.col("reliability").isNull()).select(
        "sub_geography", "period", "category"
    ).orderBy("sub_geography", "period", "category").limit(100)


@query(f"""WITH {CELLS} SELECT sub_geography, period, count(*) AS n_cells FROM cells GROUP BY 1, 2 HAVING count(value) = 0""")
def fully_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier quarters whose every category is withheld or absent."""
    from tallymart.plans.shaping import wide_to_long

    return quality.fully_suppressed(wide_to_long(spark, sf_dir), ["sub_geography", "period"])


@query("""SELECT p_brand, p_size, p_name, count(*) OVER (PARTITION BY p_brand, p_size) AS n_members
FROM (SELECT DISTINCT p_brand, p_size, p_name FROM part)""")
def collect_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members sharing a value, one row per member."""
    return analytics.members_by_value(inputs.table(spark, sf_dir, "part"), ["p_brand", "p_size"], "p_name")


@query("""WITH g AS (SELECT l_suppkey, l_partkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
SELECT l_suppkey AS table_id, count(*) FILTER (n > 1) AS n_repeated, count(*) FILTER (n > 1) = 0 AS passes FROM g GROUP BY 1""")
def gate_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stand for tables: a repeated (part, date) key rejects the table."""
    lines = inputs.table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "table_id")
    return quality.duplicate_key_gate(lines, "table_id", ["l_partkey", "l_shipdate"])


@query(f"""WITH {CELLS}, g AS (SELECT sub_geography, period, category, count(value) AS n FROM cells GROUP BY 1, 2, 3)
SELECT sub_geography || ' ' || period AS table_id, count(*) FILTER (n = 0) AS n_empty, count(*) FILTER (n = 0) = 0 AS passes FROM g GROUP BY 1""")
def gate_null_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category without any value rejects the table (here one supplier's quarter)."""
    from tallymart.plans.shaping import wide_to_long

    named = F.concat_ws(" ", "sub_geography", F.col("period").cast("string"))
    return quality.null_category_gate(wide_to_long(spark, sf_dir).withColumn("table_id", named), "table_id")


@query("""SELECT p_name AS slug, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1""")
def repeated_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that ought to be unique and are not."""
    return quality.repeated_keys(inputs.table(spark, sf_dir, "part").select(F.col("p_name").alias("slug")), "slug")


@query(f"""WITH {OBS} SELECT period, sub_geography, category, value, reliability, survey, table_id, geography, 'export' AS source FROM obs
UNION ALL SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE), NULL, o_orderpriority, o_totalprice, NULL, 'Orders', 'orders',
  replace(c_name || '/' || c_mktsegment, '/', '-'), 'static' FROM orders JOIN customer ON o_custkey = c_custkey""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lanes with different columns in one contract; place names made alike."""
    from tallymart.operators.lanes import union_lanes

    exported = inputs.obs(spark, sf_dir).drop("province")
    static = inputs.table(spark, sf_dir, "orders").join(
        inputs.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        inputs.quarter(F.col("o_orderdate")).alias("period"), F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("value"), F.lit("Orders").alias("survey"), F.lit("orders").alias("table_id"),
        F.concat_ws("/", "c_name", "c_mktsegment").alias("geography"),
    )
    return union_lanes({"export": exported, "static": static})
