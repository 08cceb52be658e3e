"""Archive and mart builds seen from their results: rejects, statuses, views, published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import catalogue, geo, latency, mart, matrix, tidy
from tallymart.plans import inputs, market
from tallymart.plans.inputs import FACT, OBS
from tallymart.plans.registry import query
from tallymart.plans.sourcing import PAGES, json_catalogue
from tallymart.session import shared_folder
from tallymart.sources import files, sinks
from tallymart.sources import manifest as manifests


def _customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer; those in debt hold no table."""
    table = F.concat(F.lit(" Heading \r\n,Balance,Number,\r\nJan 2001,"), F.lit('"'), F.format_number("c_acctbal", 2), F.lit('",'), F.col("c_custkey").cast("string"), F.lit(",\r\n"))
    text = F.when(F.col("c_acctbal") < 0, F.lit(" Heading \r\nNo data available.\r\n")).otherwise(table)
    return inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("geography"), F.lit("Historical Time Periods").alias("breakdown"), F.encode(text, "ISO-8859-1").alias("content"))


@query("""SELECT lane, CAST(c_custkey AS VARCHAR) AS geography, 'No data table found' AS reason
FROM customer CROSS JOIN (VALUES ('row'), ('line')) l(lane) WHERE c_acctbal < 0""")
def rejected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a table, found alike by both lanes."""
    described = _customer_files(spark, sf_dir)
    lines = described.select("geography", F.posexplode(tidy.file_lines(F.col("content"))).alias("pos", "line"))
    by_row = tidy.rejected_files(described, ["geography"]).select(F.lit("row").alias("lane"), "geography", "reason")
    by_line = tidy.rejected_lines(lines, described, ["geography"]).select(F.lit("line").alias("lane"), "geography", "reason")
    return by_row.unionByName(by_line)


def _crew_books(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A book per nation with a sheet per customer; the BUILDING segment's sheets have no header row."""
    who = inputs.table(spark, sf_dir, "customer").join(inputs.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    headed = F.col("c_mktsegment") != "BUILDING"
    rows = F.array(
        F.struct(F.lit(0).cast("bigint").alias("row_idx"), F.array(F.lit("Balance")).alias("cells")),
        F.struct(F.lit(1).cast("bigint").alias("row_idx"), F.when(headed, F.array(F.lit("Geography"), F.lit("2001"), F.lit("2002"))).otherwise(F.array(F.lit("see notes"))).alias("cells")),
        F.struct(F.lit(2).cast("bigint").alias("row_idx"), F.array(F.col("c_name"), F.col("c_custkey").cast("string"), F.lit("withheld")).alias("cells")),
    )
    grid = who.select(F.col("n_name").alias("file"), F.col("c_name").alias("sheet"), F.inline(rows))
    recipe = matrix.Recipe("crew", "period", sheet_dimension="category", header_marker="Geography", null_tokens=("withheld",))
    books = inputs.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("file"), F.lit("none").alias("first_sheet"), F.lit("Crews").alias("survey"), F.col("n_name").alias("table_id"),
        F.lit("Crews").alias("title"), F.lit("crew").alias("slug"))
    return grid, books.join(matrix.recipe_frame(spark, [recipe]), "slug")


@query("""SELECT n_name AS file, c_name AS sheet, 'No header row found' AS reason
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'""")
def headerless_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets that yield nothing are named instead of vanishing."""
    return matrix.headerless_sheets(*_crew_books(spark, sf_dir))


@query("""SELECT n_name AS table_id, c_name AS geography, c_name AS category, DATE '2001-01-01' + INTERVAL (y) YEAR AS period,
  CASE WHEN y = 0 THEN CAST(c_custkey AS DOUBLE) END AS value, 'static' AS source
FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (VALUES (0), (1)) v(y) WHERE c_mktsegment <> 'BUILDING'""".replace(
    "DATE '2001-01-01' + INTERVAL (y) YEAR", "CASE y WHEN 0 THEN DATE '2001-01-01' ELSE DATE '2002-01-01' END"))
def workbook_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook grids through the incremental build and back; null tokens come from the recipe."""
    grid, books = _crew_books(spark, sf_dir)
    clean = shared_folder(spark, "workbooks")
    sinks.build_workbooks(spark, grid, books, clean)
    return sinks.read_archive(spark, clean).select("table_id", "geography", "category", "period", "value", "source")


@query(f"""WITH {OBS} SELECT geography, count(*) AS n, count(value) AS n_published, max(value) AS highest
FROM obs WHERE table_id = '2.1.11.4' GROUP BY 1""")
def stored_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive's surveys as views, queried in SQL."""
    clean = shared_folder(spark, "views")
    sinks.write_archive(inputs.obs(spark, sf_dir).drop("province"), clean)
    sinks.register_archive(spark, clean, ["Rms"])
    return spark.sql("SELECT geography, count(*) AS n, count(value) AS n_published, max(value) AS highest FROM rms WHERE table_id = '2.1.11.4' GROUP BY geography")


@query("""SELECT 'World' AS name, '1' AS place_id, 0 AS tier UNION ALL SELECT r_name, 'P' || r_regionkey, 1 FROM region
UNION ALL SELECT n_name, 'M' || n_nationkey, 2 FROM nation""")
def all_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list that names are looked up in: country, provinces, metros."""
    region, nation = inputs.table(spark, sf_dir, "region"), inputs.table(spark, sf_dir, "nation")
    return geo.all_places(
        region.select(F.lit("World").alias("name"), F.lit("1").alias("place_id")).distinct(),
        region.select(F.col("r_name").alias("name"), F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("place_id")),
        nation.select(F.col("n_name").alias("name"), F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("place_id")),
    )


@query(f"""WITH {PAGES} SELECT 'Rental Market' AS survey, count(*) AS n_pages, count(*) FILTER (n_found > 0) AS n_downloadable,
  count(*) FILTER (n_found = 0) AS n_missing, CAST(sum(CASE WHEN n_found > 0 THEN k END) AS BIGINT) AS n_bytes FROM pages_of""")
def asset_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with and without a file to download."""
    return catalogue.asset_status(json_catalogue(spark, sf_dir))


@query(f"""WITH {PAGES}, asked AS (SELECT o_orderkey, 'page-' || o_custkey AS slug FROM orders)
SELECT o_orderkey, asked.slug, p.slug IS NOT NULL AS known, CASE WHEN n_found > 0 THEN 'https://files.example.org/' || event_id || '-1.xlsx' END AS asset_url
FROM asked LEFT JOIN pages_of p USING (slug)""")
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages asked for by slug; unknown ones are marked."""
    asked = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("page-"), F.col("o_custkey").cast("string")).alias("slug"))
    return catalogue.pages_by_slug(json_catalogue(spark, sf_dir), asked).select("o_orderkey", "slug", "known", "asset_url")


@query(f"""WITH {FACT}, near AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA')
SELECT geo_name, geo_level, count(*) AS n FROM fact
WHERE geo_level = 'Province'
  OR geo_level = 'CMA' AND substr(geo_id, 7) IN (SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') FROM customer JOIN near ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING')
  OR geo_level = 'CSD' AND geo_name IN (SELECT c_name || ' (T)' FROM customer JOIN near ON c_nationkey = n_nationkey)
GROUP BY 1, 2""")
def province_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of one province: metros without a member district are unknown places and leave the fact."""
    near = inputs.table(spark, sf_dir, "nation").join(inputs.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("r_name") == "AMERICA")
    own = inputs.table(spark, sf_dir, "customer").join(near, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    members = inputs.members(spark, sf_dir).join(own.select(F.col("c_name").alias("name")), "name", "left_semi")
    directory = geo.place_directory(inputs.provinces(spark, sf_dir), inputs.metros(spark, sf_dir), members, province_id=F.concat(F.lit("PR:"), "geo_name"))
    placed = mart.place_fact(inputs.market(spark, sf_dir), market.table_map(spark), directory)
    return placed.groupBy("geo_name", "geo_level").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FACT} SELECT count(*) AS n_observations, count(*) FILTER (is_suppressed) AS n_suppressed, count(DISTINCT geo_id) AS n_places,
  (SELECT count(*) FROM fact WHERE metric_id = 3 AND dimension = 'Bedroom Type') AS n_rents, 'r7' AS revision FROM fact""")
def mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published mart read back: its provenance row, its fact, one projection."""
    path = shared_folder(spark, "mart")
    sinks.write_mart(
        spark, inputs.market(spark, sf_dir), path, metrics=market.metric_table(spark), table_map=market.table_map(spark),
        directory=market.directory(spark, sf_dir), province=F.lit("Home"), revision="r7")
    meta = spark.read.parquet(f"{path}/_meta").select("n_observations", "n_suppressed", F.col("portal_commit").alias("revision"))
    fact = spark.read.parquet(f"{path}/rental_observations").agg(F.count_distinct("geo_id").alias("n_places"))
    rents = sinks.read_projection(spark, path, "average_rent_by_bedroom").agg(F.count(F.lit(1)).alias("n_rents"))
    stacked = meta.unionByName(fact, allowMissingColumns=True).unionByName(rents, allowMissingColumns=True)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


@query("""SELECT event_type AS outcome, count(*) AS n, count(DISTINCT user_id) AS n_tables, max(value) AS worst FROM events GROUP BY 1""")
def log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log records appended as JSON lines and scanned again."""
    path = shared_folder(spark, "log")
    sinks.append_log(inputs.table(spark, sf_dir, "events").select(
        "ts", F.lit("Rms").alias("survey"), F.col("user_id").cast("string").alias("table_id"), F.col("event_type").alias("outcome"), F.col("value").alias("latency_s")), path)
    return files.run_log(spark, path).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("table_id").alias("n_tables"), F.max("latency_s").alias("worst"))


@query("""SELECT '59' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS metro_uid, lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS metro_code,
  replace(n_name, '_', '/') AS name FROM nation""")
def lookup_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference CSV keeps the leading zeros of its codes."""
    path = shared_folder(spark, "lookup")
    inputs.metros(spark, sf_dir).write.option("header", "true").csv(path)
    return files.lookup(spark, path)


@query("""WITH f AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
t AS (SELECT *, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS grown, o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AS gone FROM f)
SELECT o_orderstatus AS survey, o_orderpriority AS table_id, 'added' AS first_change,
  CASE WHEN grown THEN 'grown' WHEN gone THEN 'removed' ELSE 'same' END AS second_change, grown AS listed,
  CAST(CASE WHEN grown THEN 2 * n WHEN gone THEN 0 ELSE n END AS BIGINT) AS rows_now
FROM t""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw tree (a folder per order status and priority) compared with its manifest twice.

    Between the runs one folder gets more files and another goes; the second run lists the
    files of the grown folder alone and finds the removed one from the manifest.
    """
    root, store = shared_folder(spark, "raw-tree"), shared_folder(spark, "manifest")
    folders = ["o_orderstatus", "o_orderpriority"]
    orders = inputs.table(spark, sf_dir, "orders").select(*folders, "o_orderkey", "o_totalprice")
    orders.write.partitionBy(*folders).csv(root)
    first = manifests.diff(spark, root, store, run="first")
    grown = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    orders.where(grown).write.mode("append").partitionBy(*folders).csv(root)
    sinks.remove_folder(spark, f"{root}/o_orderstatus=O/o_orderpriority=2-HIGH")
    second = manifests.diff(spark, root, store, run="second")

    def named(df: DataFrame) -> DataFrame:
        return df.withColumns({k: F.regexp_replace(k, "^[^=]*=", "") for k in ("survey", "table_id")})

    before = named(first.changes).groupBy("survey", "table_id").agg(F.max("change").alias("first_change"))
    moved = named(second.changes).groupBy("survey", "table_id").agg(
        F.when(F.max(F.col("change") == "removed"), "removed").when(F.max(F.col("change") == "added"), "grown").otherwise("same").alias("second_change"))
    listed = named(spark.createDataFrame(second.listed, "survey string, table_id string")).withColumn("listed", F.lit(True))
    now = spark.read.csv(root).groupBy(F.col("o_orderstatus").alias("survey"), F.col("o_orderpriority").alias("table_id")).agg(F.count(F.lit(1)).alias("rows_now"))
    return (
        before.join(moved, ["survey", "table_id"], "left").join(listed, ["survey", "table_id"], "left").join(now, ["survey", "table_id"], "left")
        .select("survey", "table_id", "first_change", F.coalesce("second_change", F.lit("same")).alias("second_change"),
                F.coalesce("listed", F.lit(False)).alias("listed"), F.coalesce("rows_now", F.lit(0)).cast("long").alias("rows_now"))
    )


def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of latency per outcome from day sketches; the later half of the days is processed twice and counts once.

    Not a registered query, since every registered one has an SQL twin and quantiles of a
    sketch have none; ``tests/test_latency.py`` holds them against exact ranks and the counts
    against SQL.
    """
    path = shared_folder(spark, "latency-sketches")
    log = inputs.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("outcome"), F.col("value").alias("latency_s"))
    middle = log.agg(F.percentile_approx(F.to_date("ts"), 0.5).alias("m")).first()["m"]  # a day: re-runs take whole days
    later = log.where(F.to_date("ts") >= F.lit(middle))
    latency.store_days(latency.day_sketches(log), path)
    latency.store_days(latency.day_sketches(later), path)  # a re-run of those days replaces their sketches
    return latency.quantiles(spark, path)
