"""Scalar parsing, naming and filtering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import functions as fn
from tallymart.operators import analytics, geo, mart
from tallymart.operators.catalogue import find_tables
from tallymart.plans import inputs
from tallymart.plans.inputs import OBS
from tallymart.plans.registry import query


@query("""SELECT o_orderkey, o_orderstatus, CASE o_orderpriority
  WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'F' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END
  WHEN '4-NOT SPECIFIED' THEN CAST(date_trunc('year', o_orderdate) AS DATE)
  WHEN '3-MEDIUM' THEN CAST(date_trunc('quarter', o_orderdate) AS DATE)
  ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS period FROM orders""")
def parse_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every notation of a period, and texts that are none."""
    date, kind, status = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    short = F.date_format(date, "MMM yyyy")
    text = (
        F.when(kind == "1-URGENT", F.concat(F.lit(" "), F.replace(short, F.lit("Sep"), F.lit("Sept"))))
        .when(kind == "2-HIGH", F.upper(F.date_format(date, "yyyy  MMMM")))
        .when(kind == "3-MEDIUM", F.date_format(date, "yyyy/'Q'q"))
        .when(kind == "4-NOT SPECIFIED", F.date_format(date, "yyyy"))
        .when(status == "F", F.lower(short))
        .when(status == "O", F.concat(F.lit("1"), F.date_format(date, "yyyy")))
        .otherwise(F.concat(short, F.lit(" to 2025")))
    )
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", fn.parse_period(text).alias("period"))


_NUMBER_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {null_case}
  ELSE l_extendedprice END AS value FROM lineitem"""


def _number_text(signed: bool):
    price, flag = F.col("l_extendedprice"), F.col("l_returnflag")
    text = F.format_number(price, 2)
    return (
        F.when((flag == "A") & (F.col("l_linestatus") == "F"), F.lit("**"))
        .when((flag == "A") & (F.col("l_linenumber") > 3), F.concat(price.cast("decimal(18,2)").cast("string"), F.lit("d")))
        .when((flag == "N") & (F.col("l_linenumber") == 1), F.lit(",x," if signed else " N/A "))
        .otherwise(F.concat(F.lit(" "), text, F.lit("\t")))
    )


_NULLS = """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL
  WHEN l_returnflag = 'A' AND l_linenumber > 3 THEN NULL WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL"""
_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(_NUMBER_SQL.format(null_case=_NULLS))
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands commas, blanks, null tokens and near-numbers such as 12.50d."""
    return inputs.table(spark, sf_dir, "lineitem").select(*_LINE, fn.parse_number(_number_text(False)).alias("value"))


@query(_NUMBER_SQL.format(null_case=_NULLS))
def parse_value_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "lineitem").select(*_LINE, fn.parse_grid_number(_number_text(True)).alias("value"))


@query("""SELECT p_partkey, replace(p_brand || '/' || p_type, '/', '-') || '-' || p_size || '-' || p_name AS canonical,
  replace(replace(p_name || '/' || p_type, '/', '-'), ' ', '_') AS file_name,
  replace(replace(p_name || '/' || p_type, '/', '-'), '_', ' ') AS place FROM part""")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical spelling, and the way to a file name and back (lossy)."""
    place = F.concat_ws("/", "p_name", "p_type")
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey", fn.normalize_name(F.concat(F.concat_ws("/", "p_brand", "p_type"), F.lit("\u2013"), F.col("p_size").cast("string"), F.lit("\u2014"), "p_name")).alias("canonical"),
        fn.place_to_file_name(place).alias("file_name"),
        fn.file_name_to_place(fn.place_to_file_name(place)).alias("place"),
    )


@query(f"""WITH {OBS} SELECT geography, sub_geography, period, category,
  value IS NULL AND reliability IS NULL AS is_suppressed,
  CASE WHEN value IS NOT NULL THEN 'published' WHEN reliability IS NULL THEN 'withheld_no_code' ELSE 'withheld_with_code' END AS null_reason
FROM obs""")
def is_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, code = F.col("value"), F.col("reliability")
    return inputs.obs(spark, sf_dir).select(
        "geography", "sub_geography", "period", "category",
        mart.is_suppressed(value, code).alias("is_suppressed"), mart.null_reason(value, code).alias("null_reason"),
    )


@query(f"""WITH {OBS} SELECT sub_geography, period, category, CAST(round_even(value * 5, 0) AS INTEGER) AS rounded FROM obs""")
def round_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves go to the even neighbour (values times five end in .0 or .5)."""
    return inputs.obs(spark, sf_dir).select(
        "sub_geography", "period", "category", fn.round_to_int(F.col("value") * 5).alias("rounded")
    )


@query(f"""WITH {OBS} SELECT sub_geography, category, strftime(period, '%b %Y') AS period, CAST(year(period) AS SMALLINT) AS period_year,
  coalesce(reliability, '—') AS reliability, value FROM obs WHERE value IS NOT NULL""")
def display_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a map hover shows: published values, month and year, a dash for no code."""
    return inputs.obs(spark, sf_dir).where(F.col("value").isNotNull()).select(
        "sub_geography", "category", fn.period_label(F.col("period")).alias("period"),
        fn.period_year(F.col("period")).alias("period_year"),
        F.coalesce("reliability", F.lit("—")).alias("reliability"), "value",
    )


@query(r"""SELECT page_id, regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) AS slug,
  regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS file_name FROM pages""")
def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last segment as printed, and without query string or fragment."""
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id", fn.url_slug(F.col("url")).alias("slug"), fn.url_file_name(F.col("url")).alias("file_name")
    )


@query(r"""SELECT page_id, CASE WHEN regexp_matches(html, '(?s)<h1[^>]*>.*?</h1>') THEN
  trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '[\s\p{Z}]+', ' ', 'g')) END AS title
FROM pages""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "pages").select("page_id", fn.page_title(F.col("html")).alias("title"))


@query(r"""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'href="(/[^"/?#]+)"', 1))), ' ') AS leaves,
  array_to_string(list_sort(list_distinct(regexp_extract_all(replace(replace(html, 'href="/', 'href="https://files.example.org/'), '</a>', '.XLSX</a>'),
    '(?i)(https://files\.example\.org/[^"''<> ]+?\.(?:xlsx|xls|csv))', 1))), ' ') AS assets,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, 'href="/([^"]+)"', 1),
    lambda x: 'https://files.example.org/' || x || '.csv'))), '|') AS all_links_as_assets
FROM pages""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf links of a section, and download links of a host.

    The pages link to no downloads, so link targets are also read rewritten to a file host.
    """
    html, host = F.col("html"), "https://files.example.org"
    hosted = F.replace(F.replace(html, F.lit('href="/'), F.lit(f'href="{host}/')), F.lit("</a>"), F.lit(".XLSX</a>"))
    as_files = F.regexp_replace(html, r'href="/([^"]+)"', f'href="{host}/$1.csv"')
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(fn.leaf_links(html, ""), " ").alias("leaves"),
        F.array_join(fn.asset_links(hosted, host), " ").alias("assets"),
        F.array_join(fn.asset_links(as_files, host), "|").alias("all_links_as_assets"),
    )


@query("""WITH bodies AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN 500 ELSE 200 END AS status,
  CASE WHEN lang = 'de' THEN 'No data available.' || chr(13) || chr(10) ELSE '' END || text AS body FROM documents)
SELECT doc_id, CASE WHEN status >= 400 THEN 'http_' || status
  WHEN contains(left(body, 2000), 'No data available') OR contains(left(body, 2000), 'This data series is now archived') THEN 'empty' ELSE 'ok' END AS outcome,
  CAST(len(list_filter(regexp_split_to_array(body, '\\r\\n|[\\n\\r\\x0b\\x0c]'), lambda l: trim(l, ' ' || chr(9) || chr(160)) <> '')) AS INTEGER) AS n_lines
FROM bodies""")
def body_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome class and size of response bodies (status and marker by language)."""
    marked = F.when(F.col("lang") == "de", F.concat(F.lit("No data available.\r\n"), "text")).otherwise(F.col("text"))
    status = F.when(F.col("lang") == "fr", 500).otherwise(200)
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", fn.body_outcome(status, F.encode(marked, "UTF-8")).alias("outcome"),
        fn.non_blank_lines(marked).alias("n_lines"),
    )


@query("""SELECT s_suppkey, s_name, replace(s_name, '#', '') || CAST(s_nationkey AS VARCHAR) || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS composite_id
FROM supplier WHERE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') LIKE '1%' AND trim(s_name) <> ''""")
def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids starting with a province code, blank ids dropped, and a composite key."""
    nation = F.col("s_nationkey").cast("string")
    return (
        inputs.table(spark, sf_dir, "supplier")
        .where(F.lpad(nation, 2, "0").startswith("1") & (fn.strip(F.col("s_name")) != ""))
        .select(
            "s_suppkey", "s_name",
            F.concat(F.replace("s_name", F.lit("#"), F.lit("")), nation, F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("composite_id"),
        )
    )


@query("""SELECT p_partkey, p_type AS survey, p_brand AS series, p_name AS dimension FROM part
WHERE p_type = 'ECONOMY' AND p_name LIKE '%' AND p_brand = 'Brand#2'""")
def catalogue_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AND of the fields given, the others left open; parts stand for tables."""
    tables = inputs.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("survey"), F.col("p_brand").alias("series"), F.col("p_name").alias("dimension")
    )
    return find_tables(tables, survey="ECONOMY", series="Brand#2", dimension=None)


@query(f"""WITH {OBS} SELECT geography, sub_geography, period, value FROM obs
WHERE geography IN ('NATION_1', 'NATION_7', 'NATION_12') AND category = 'AF' AND value IS NOT NULL""")
def series_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.published_series(
        inputs.obs(spark, sf_dir), "geography", ["NATION_1", "NATION_7", "NATION_12"], "AF"
    ).select("geography", "sub_geography", "period", "value")


@query("""WITH hits AS (SELECT DISTINCT p_name AS name, CASE WHEN p_name = 'Red' THEN 0 ELSE 1 END AS rank FROM part
  WHERE contains(lower(p_name), 'red'))
SELECT 'Red' AS query, name, rank, (SELECT count(*) FROM hits h WHERE h.rank = hits.rank) AS n_hits
FROM hits WHERE rank = (SELECT min(rank) FROM hits)""")
def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.search_names(inputs.table(spark, sf_dir, "part").select(F.col("p_name").alias("name")), "Red")
