"""Sources, sinks, manifests and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import analytics, catalogue, jobs, quality
from tallymart.plans import inputs
from tallymart.plans.inputs import OBS
from tallymart.plans.registry import query
from tallymart.session import shared_folder
from tallymart.sources import files, geojson, sinks
from tallymart.streaming import stream_latency


@query(f"""WITH {OBS} SELECT DISTINCT survey, table_id, replace(sub_geography, '_', ' ') AS geography,
  '/lake/raw/Rms/2.1.11.4/' || sub_geography || '.csv' AS path FROM obs""")
def scan_path_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey, table and place from file paths; deeper or shallower paths are not tables."""
    places = inputs.obs(spark, sf_dir).select("survey", "table_id", "sub_geography").distinct()
    tail = F.concat(F.translate("sub_geography", "/ ", "-_"), F.lit(".csv"))
    paths = places.select(F.explode(F.array(
        F.concat_ws("/", F.lit("/lake/raw"), "survey", "table_id", tail),
        F.concat_ws("/", F.lit("/lake/raw"), "survey", tail),
        F.concat_ws("/", F.lit("/lake/raw"), "survey", "table_id", F.lit("old"), tail),
    )).alias("path"))
    return files.with_path_fields(paths, "/lake/raw")


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source, count(*) AS n_rows, TRUE AS all_stamped FROM {t}"
    for t in ("lineitem", "orders", "customer", "supplier", "events")
))
def scan_with_mtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped with the modification time of the file they come from."""
    parts = [
        files.read_stamped(spark, [f"{sf_dir}/{t}.parquet"]).select(F.lit(t).alias("source"), "updated_at")
        for t in ("lineitem", "orders", "customer", "supplier", "events")
    ]
    stamped = parts[0]
    for part in parts[1:]:
        stamped = stamped.unionByName(part)
    return stamped.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.col("updated_at").isNotNull()).alias("all_stamped")
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per event: purchases carry assets in the page, clicks only after rendering."""
    kind = F.col("event_type")
    n_assets = F.when(F.col("value") > 100, 2).otherwise(1)
    assets = F.transform(
        F.sequence(F.lit(1), n_assets),
        lambda i: F.struct(
            F.concat(F.lit("https://files.example.org/"), F.col("event_id").cast("string"), F.lit("-"), i.cast("string"), F.lit(".xlsx")).alias("url"),
            F.get_json_object("props", "$.k").cast("bigint").alias("size_bytes"),
            F.date_format("ts", "yyyy-MM-dd").alias("last_modified"),
        ),
    )
    none = F.slice(assets, 1, 0)
    return inputs.table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.lit("page"), F.col("event_id").cast("string")).alias("slug"),
        F.concat(F.lit("https://www.example.org/tables/page-"), F.col("event_id").cast("string"), F.lit("/")).alias("page_url"),
        F.when(kind == "purchase", assets).otherwise(none).alias("found"),
        F.when(kind == "click", assets).otherwise(none).alias("rendered"),
    )


PAGES = """pages_of AS (
  SELECT 'page-' || event_id AS slug, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_type = 'purchase' THEN n ELSE 0 END AS n_found,
         CASE WHEN event_type = 'click' THEN n ELSE 0 END AS n_rendered
  FROM (SELECT *, CASE WHEN value > 100 THEN 2 ELSE 1 END AS n FROM events) e)"""


@query(f"""WITH {PAGES} SELECT slug AS table_id, 'Rental Market' AS survey, 'rental-market' AS section, 'Page ' || slug AS title,
  'https://www.example.org/tables/' || slug || '/' AS page_url,
  CASE WHEN n_found > 0 THEN 'https://files.example.org/' || event_id || '-1.xlsx' END AS asset_url,
  CASE WHEN n_found > 0 THEN k END AS size_bytes FROM pages_of""")
def json_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested page catalogue, written as JSON text and read back: first asset, section label."""
    entry = F.struct(
        "page_url", F.concat(F.lit("Page "), "slug").alias("title"), F.lit("rental-market").alias("section"),
        F.col("found").alias("assets"),
    )
    text = _pages(spark, sf_dir).select(F.to_json(F.struct(F.array(entry).alias("tables"))).alias("value"))
    raw = text.select(F.from_json("value", files.PAGE_CATALOGUE_SCHEMA).alias("c")).select("c.tables")
    return catalogue.page_catalogue(raw).drop("last_modified")


@query(f"""WITH {PAGES} SELECT 'https://www.example.org/tables/' || slug || '/' AS page_url,
  CAST(CASE WHEN n_found > 0 THEN n_found ELSE n_rendered END AS INTEGER) AS n_assets,
  CASE WHEN n_found > 0 THEN 'html' WHEN n_rendered > 0 THEN 'render' END AS discovery,
  CASE WHEN n_found + n_rendered > 0 THEN 'https://files.example.org/' || event_id || '-1.xlsx' END AS first_asset
FROM pages_of""")
def second_pass_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _filled_pages(spark, sf_dir)
    return filled.select(
        "page_url", F.size("assets").alias("n_assets"), "discovery",
        F.try_element_at("assets", F.lit(1))["url"].alias("first_asset"),
    )


def _filled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return catalogue.fill_from_second_pass(
        pages.select("page_url", F.col("found").alias("assets")),
        pages.where(F.size("rendered") > 0).select("page_url", F.col("rendered").alias("assets")),
    )


@query(f"""WITH {PAGES} SELECT count(*) AS n_pages, count(*) FILTER (n_found + n_rendered > 0) AS n_with_files,
  CAST(sum(CASE WHEN n_found > 0 THEN n_found ELSE n_rendered END) AS BIGINT) AS n_files,
  count(*) FILTER (n_found > 0) AS n_html, count(*) FILTER (n_found = 0 AND n_rendered > 0) AS n_render FROM pages_of""")
def discovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.discovery_summary(_filled_pages(spark, sf_dir))


@query("""SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature collections as JSON text, flattened and kept by province property."""
    located = (
        inputs.table(spark, sf_dir, "customer")
        .join(inputs.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(inputs.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    feature = F.struct(
        F.struct(F.col("c_custkey").cast("string").alias("CSDUID"), F.col("c_name").alias("NAME"),
                 F.col("n_name").alias("PRNAME"), F.col("r_name").alias("PRUID")).alias("properties"),
        F.struct(F.lit("Point").alias("type")).alias("geometry"),
    )
    text = located.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    kept = geojson.features(text, province_key="PRUID", province="ASIA")
    p = F.col("properties")
    return kept.select(
        p["CSDUID"].cast("bigint").alias("c_custkey"), p["NAME"].alias("c_name"), p["PRNAME"].alias("n_name")
    )


@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'id,k' ELSE 'id,k,value' END AS kept,
  CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events""")
def map_scrub_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties whose value is NaN go; others, also nulls, stay."""
    value = F.when(F.col("event_type").isin("click", "view"), "NaN").otherwise(F.col("value").cast("string"))
    props = F.create_map(
        F.lit("id"), F.col("event_id").cast("string"), F.lit("k"), F.get_json_object("props", "$.k"), F.lit("value"), value
    )
    scrubbed = inputs.table(spark, sf_dir, "events").select("event_id", geojson.scrub_nan(props).alias("p"))
    return scrubbed.select(
        "event_id", F.array_join(F.array_sort(F.map_keys("p")), ",").alias("kept"), F.col("p")["k"].alias("k")
    )


@query(f"WITH {OBS} SELECT survey, table_id, geography, sub_geography, period, category, value, reliability FROM obs")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job writes every table partitioned by survey and table id; the result is read back."""
    path = shared_folder(spark, "archive")
    sinks.write_archive(inputs.obs(spark, sf_dir).drop("province"), path)
    return sinks.read_archive(spark, path).select(
        "survey", "table_id", "geography", "sub_geography", "period", "category", "value", "reliability"
    )


@query("""WITH i AS (SELECT user_id, max(ts) AS m, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'signup', 'error') GROUP BY 1),
 o AS (SELECT user_id, max(ts) AS b FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT i.user_id, CAST(m AS VARCHAR) AS modified, n AS n_inputs FROM i LEFT JOIN o USING (user_id) WHERE b IS NULL OR m > b""")
def stale_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users stand for tables, purchases for builds: those with newer inputs are stale."""
    events = inputs.table(spark, sf_dir, "events")
    built = F.col("event_type") == "purchase"
    stale = quality.stale_tables(
        events.where(~built).select("user_id", F.col("ts").alias("modified")),
        events.where(built).select("user_id", F.col("ts").alias("built")), ["user_id"],
    )
    return stale.select("user_id", F.col("modified").cast("string").alias("modified"), "n_inputs")


@query("""WITH r AS (SELECT l_partkey, max(l_returnflag) AS f FROM lineitem GROUP BY 1)
SELECT CASE f WHEN 'A' THEN 'ok' WHEN 'N' THEN 'skipped' WHEN 'R' THEN 'error' ELSE 'missing' END AS status, count(*) AS n
FROM part LEFT JOIN r ON p_partkey = l_partkey GROUP BY 1""")
def build_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts stand for planned tables, the flags of their orders for build results."""
    flag = F.col("flag")
    results = (
        inputs.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("table_id")).agg(F.max("l_returnflag").alias("flag"))
        .select("table_id", F.when(flag == "A", "ok").when(flag == "N", "skipped").otherwise("error").alias("status"))
    )
    planned = inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("table_id"))
    return quality.build_status_counts(planned, results, "table_id")


@query("""SELECT event_type AS outcome, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 3))) AS DOUBLE) / count(value) AS avg_latency,
  max(value) AS max_latency FROM events GROUP BY 1""")
def log_latency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run-log summary driven by a file stream with a checkpoint."""
    schema = inputs.table(spark, sf_dir, "events").schema
    log = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = shared_folder(spark, "stream")
    stream_latency(
        log.select(F.col("event_type").alias("outcome"), F.col("value").alias("latency_s")), f"{out}/summary", f"{out}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{out}/summary")


# --- run log: events as attempts, event type as outcome --------------------------


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return inputs.table(spark, sf_dir, "events").select(
        "ts", F.col("user_id").alias("table_id"), F.get_json_object("props", "$.k").alias("geography"),
        F.when(kind == "error", "error").when(kind.isin("view", "click"), "empty").otherwise("ok").alias("outcome"),
        F.col("value").alias("latency_s"),
    )


LOG = """log AS (SELECT ts, user_id AS table_id, json_extract_string(props, '$.k') AS geography,
  CASE WHEN event_type = 'error' THEN 'error' WHEN event_type IN ('view', 'click') THEN 'empty' ELSE 'ok' END AS outcome,
  value AS latency_s FROM events)"""


@query(f"WITH {LOG} SELECT table_id, count(*) AS n FROM log WHERE outcome = 'error' GROUP BY 1")
def log_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.outcomes_by(run_log(spark, sf_dir), "table_id", "error")


@query(f"""WITH {LOG} SELECT outcome, count(*) AS n,
  CAST(sum(CAST(latency_s AS DECIMAL(18, 2))) AS DOUBLE) / count(latency_s) AS avg_latency, max(latency_s) AS max_latency FROM log GROUP BY 1""")
def log_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.latency_by_outcome(run_log(spark, sf_dir), F.col("latency_s").cast("decimal(18,2)"))


@query(f"""WITH {LOG} SELECT table_id || '/' || geography AS table_key, count(*) AS n_attempts,
  CASE WHEN bool_and(outcome = 'empty') THEN 'suspect_request' WHEN bool_and(outcome = 'error') THEN 'dead_table' ELSE 'serving' END AS verdict
FROM log GROUP BY 1""")
def coverage_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = run_log(spark, sf_dir).withColumn("table_key", F.concat_ws("/", "table_id", "geography"))
    return quality.coverage_verdict(keyed, "table_key")


_OUTCOMES = """outcomes AS (
  SELECT l_suppkey AS table_id, l_partkey AS geography,
         CASE l_returnflag WHEN 'A' THEN 'bare' WHEN 'N' THEN 'all' ELSE 'minus' END AS variant,
         CASE WHEN l_returnflag = 'R' THEN 'filter ' || l_linenumber END AS removed,
         CASE WHEN l_linestatus = 'F' THEN 'ok' ELSE 'empty' END AS outcome
  FROM lineitem)"""


@query(f"""WITH {_OUTCOMES}, facts AS (SELECT table_id, geography,
    coalesce(bool_or(outcome = 'ok') FILTER (variant = 'bare'), FALSE) AS b, coalesce(bool_or(outcome = 'ok') FILTER (variant = 'all'), FALSE) AS a,
    coalesce(array_to_string(list_sort(list(DISTINCT removed) FILTER (variant = 'minus' AND outcome = 'ok')), ', '), '') AS c
  FROM outcomes GROUP BY 1, 2)
SELECT table_id, geography, CASE WHEN b AND NOT a AND c <> '' THEN 'filter_breaks_request' WHEN b AND NOT a THEN 'no_single_filter_recovers'
  WHEN NOT b THEN 'bare_request_fails' ELSE 'filters_work' END AS verdict, CASE WHEN b AND NOT a THEN c ELSE '' END AS culprits FROM facts""")
def filter_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stand for tables and parts for places; return flags for request variants."""
    flag = F.col("l_returnflag")
    outcomes = inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("table_id"), F.col("l_partkey").alias("geography"),
        F.when(flag == "A", "bare").when(flag == "N", "all").otherwise("minus").alias("variant"),
        F.when(flag == "R", F.concat(F.lit("filter "), F.col("l_linenumber").cast("string"))).alias("removed"),
        F.when(F.col("l_linestatus") == "F", "ok").otherwise("empty").alias("outcome"),
    )
    return jobs.diagnose_filters(outcomes, ["table_id", "geography"])
