"""Reshaping queries: matrices, table files and workbooks to long observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import functions as fn
from tallymart.operators import matrix, reshape, tidy
from tallymart.plans import inputs
from tallymart.plans.inputs import CELLS, FILE_KEYS, TIDY
from tallymart.plans.registry import query
from tallymart.session import shared_folder

LONG = "table_id, geography, period, sub_geography, category, value, reliability"


@query(f"WITH {CELLS} SELECT geography, sub_geography, period, category, value, reliability FROM cells")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known columns, one pass: each value column with the code column to its right."""
    return reshape.wide_to_long(
        inputs.wide(spark, sf_dir).drop("province"), "sub_geography",
        is_code=lambda name: name.endswith(" code"), keep=("geography", "period"),
    )


@query(f"""{TIDY}, one AS (SELECT 1)
SELECT table_id, geography, CASE WHEN table_id = '2.2.11' THEN strftime(period, '%Y') || '/Q' || quarter(period)
            WHEN table_id = '2.2.1' THEN strftime(period, '%b %Y') WHEN table_id = '2.1.11.1' THEN sub_geography ELSE '' END AS index_text,
       category, value, reliability FROM tidy
UNION ALL
SELECT DISTINCT table_id, geography, '', category, CAST(CASE right(category, 2) WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3
       WHEN 'NO' THEN 4 WHEN 'RF' THEN 5 ELSE 6 END AS DOUBLE), NULL FROM tidy WHERE table_id = '2.2.1'
UNION ALL
SELECT DISTINCT table_id, geography, '', category, CAST(CASE right(category, 1) WHEN 'F' THEN 1 ELSE 2 END AS DOUBLE),
       CASE right(category, 1) WHEN 'F' THEN 'a' ELSE 'b' END FROM tidy WHERE table_id = '2.1.11.1'
""")
def wide_to_long_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers differ by file; summary rows are still there at this stage."""
    rows = tidy.table_rows(inputs.files(spark, sf_dir), FILE_KEYS)
    index = F.coalesce(fn.strip(F.get("cells", F.lit(0))), F.lit(""))
    return reshape.ragged_to_long(rows.select(*FILE_KEYS, index.alias("index_text"), "slots", "cells"))


@query(f"{TIDY} SELECT {LONG} FROM tidy")
def tidy_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of all layouts, one row per file, no shuffle after the input."""
    return tidy.tidy_files(inputs.files(spark, sf_dir), FILE_KEYS)


@query(f"{TIDY} SELECT {LONG} FROM tidy")
def tidy_long_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the line lane, which puts no limit on a file's size."""
    files = inputs.files(spark, sf_dir)
    # The lane scans lines several times, so they are stored like the files they stand for.
    path = shared_folder(spark, "lines")
    files.select(*FILE_KEYS, "breakdown", F.posexplode(tidy.file_lines(F.col("content"))).alias("pos", "line")).write.parquet(path)
    lines = spark.read.parquet(path)
    return tidy.tidy_lines(lines.drop("breakdown"), lines.select(*FILE_KEYS, "breakdown").distinct(), FILE_KEYS)


_BARE = """bare AS (
  SELECT c.c_custkey, k.category, CASE k.category WHEN 'Balance' THEN CASE WHEN c_acctbal >= 0 THEN round(c_acctbal, 2) END
         WHEN 'Orders' THEN CAST(n AS DOUBLE) END AS value, CAST(date_trunc('month', first) AS DATE) AS period
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first FROM orders GROUP BY 1) o ON o_custkey = c_custkey
  CROSS JOIN (VALUES ('Balance'), ('Less Than $1,500'), ('Orders')) k(category))"""


@query(f"""WITH {_BARE} SELECT CAST(c_custkey AS VARCHAR) AS geography, period, CAST(NULL AS VARCHAR) AS sub_geography, category, value,
  CAST(NULL AS VARCHAR) AS reliability FROM bare""")
def snapshot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without an index column: one per customer, its period on an earlier line."""
    orders = inputs.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first")
    )
    balance = F.when(F.col("c_acctbal") >= 0, F.format_number("c_acctbal", 2)).otherwise("**")
    text = F.concat_ws(
        "\r\n", F.lit(" Title "), F.date_format("first", "yyyy MMMM"), F.lit("Some, remark"),
        F.lit('Balance,"Less Than $1,500",Orders,'),
        F.concat(F.lit('"'), balance, F.lit('",n/a,'), F.coalesce(F.col("n").cast("string"), F.lit("n/a")), F.lit(",")),
        F.lit(""), F.lit("Source,Agency"),
    )
    files = inputs.table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("string").alias("geography"), F.lit("Snapshot").alias("breakdown"),
        F.encode(text, "ISO-8859-1").alias("content"),
    )
    return tidy.tidy_files(files, ["geography"])


@query(f"""WITH {inputs.OBS}, dated AS (
  SELECT geography, sub_geography, max(value) AS value, period FROM obs GROUP BY 1, 2, 4), flagged AS (
  SELECT *, bool_or(value IS NOT NULL) OVER (PARTITION BY sub_geography) AS any_filled FROM dated)
SELECT geography, sub_geography, period, CASE WHEN value IS NOT NULL THEN strftime(period, '%Y-%m') END AS index_text
FROM flagged WHERE value IS NOT NULL OR NOT any_filled""")
def drop_summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group = supplier; the index of a quarter without any published value is blank."""
    rows = inputs.obs(spark, sf_dir).groupBy("geography", "sub_geography", "period").agg(F.max("value").alias("value"))
    index = F.when(F.col("value").isNotNull(), F.date_format("period", "yyyy-MM")).otherwise(" ")
    return reshape.drop_summary_rows(
        rows.select("geography", "sub_geography", "period", index.alias("index_text")), ["sub_geography"], "index_text"
    )


@query(f"""WITH {CELLS} SELECT geography, sub_geography, period, category, value, reliability
FROM cells WHERE (sub_geography, category) IN (SELECT (sub_geography, category) FROM cells WHERE value IS NOT NULL)""")
def drop_dividers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group = supplier and category; groups with no value anywhere go, suppressed cells of others stay."""
    long = wide_to_long(spark, sf_dir)
    return reshape.drop_dividers(long, ["sub_geography", "category"])


def _subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    date, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.date_format(date, "MMMM\u00a0yyyy'\u00a0Row / Apartment'"))
        .when(kind == "2-HIGH", F.concat(F.date_format(date, "MMM yyyy"), F.lit("  Bedroom Type - Total ")))
        .when(kind == "3-MEDIUM", F.date_format(date, "yyyy' to 2025 Row / Apartment'"))
        .when(kind == "4-NOT SPECIFIED", F.date_format(date, "yyyy/'Q'q' Row'"))
        .otherwise(F.concat(F.lit("Row / Apartment "), F.date_format(date, "MMMM yyyy")))
    )
    return orders.select("o_orderkey", text.alias("line"))


@query("""SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
  WHEN '2-HIGH' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
  WHEN '3-MEDIUM' THEN CAST(date_trunc('year', o_orderdate) AS DATE)
  WHEN '4-NOT SPECIFIED' THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) END AS period
FROM orders""")
def subtitle_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subtitles(spark, sf_dir).select("o_orderkey", fn.subtitle_period(F.col("line")).alias("period"))


@query("""SELECT p_partkey, 5 AS n_cells, p_name AS c0, 'say "' || p_brand || '", ' || p_type AS c1, '' AS c2,
       CAST(p_size AS VARCHAR) AS c3, p_type || '"x"' AS c4 FROM part""")
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted commas, doubled quotes, an empty cell, quotes inside a bare cell."""
    line = F.concat(
        F.col("p_name"), F.lit(',"say ""'), F.col("p_brand"), F.lit('"", '), F.col("p_type"), F.lit('",,'),
        F.col("p_size").cast("string"), F.lit(","), F.col("p_type"), F.lit('"x"'),
    )
    cells = inputs.table(spark, sf_dir, "part").select("p_partkey", fn.split_csv_line(line).alias("cells"))
    return cells.select(
        "p_partkey", F.size("cells").alias("n_cells"),
        *(F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(5)),
    )


@query(f"""WITH {inputs.OBS}, sheets AS (
  SELECT DISTINCT geography || CASE province WHEN 'AFRICA' THEN ' ' || category ELSE '' END AS file,
         CASE province WHEN 'AFRICA' THEN 'Sheet1' WHEN 'ASIA' THEN category ELSE strftime(period, '%Y') || 'Q' || quarter(period) END AS sheet,
         CASE province WHEN 'AFRICA' THEN 1 + n WHEN 'ASIA' THEN 1 + 2 * n ELSE 7 END AS n_cells
  FROM obs, (SELECT 4 * (max(year(period)) - min(year(period)) + 1) AS n FROM obs))
SELECT file, sheet, CAST(2 AS BIGINT) AS header_idx, CAST(n_cells AS INTEGER) AS n_cells FROM sheets""")
def header_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header row of every sheet, by marker or by its periods."""
    grid, tables = inputs.workbook(spark, sf_dir)
    heads = matrix.header_rows(matrix.select_sheets(grid.join(tables, "file")))
    return heads.select("file", "sheet", "header_idx", F.size("header").alias("n_cells"))


@query(f"""WITH {CELLS}, quarters AS (
  SELECT CAST(unnest(range(CAST(date_trunc('year', min(period)) AS TIMESTAMP), CAST(date_trunc('year', max(period)) AS TIMESTAMP) + INTERVAL 1 YEAR, INTERVAL 3 MONTH)) AS DATE) AS period FROM obs),
spread AS (
  SELECT k.province, k.geography, k.sub_geography, k.category, q.period, o.value, o.reliability
  FROM (SELECT DISTINCT province, geography, sub_geography, category FROM cells WHERE province IN ('AFRICA', 'ASIA')) k
  CROSS JOIN quarters q LEFT JOIN obs o USING (geography, sub_geography, category, period)),
rows AS (
  SELECT geography AS file, strftime(period, '%Y-%m') AS sheet, period, category, value, CAST(NULL AS VARCHAR) AS reliability,
         'number-households-core-housing-need' AS table_id, sub_geography AS geography
  FROM cells WHERE province NOT IN ('AFRICA', 'ASIA')
  UNION ALL
  SELECT geography, category, period, category, value, reliability, 'real-average-total-household-income-before-taxes', sub_geography
  FROM spread WHERE province = 'ASIA'
  UNION ALL
  SELECT geography || ' ' || category, 'Sheet1', period, 'Title of ' || geography || ' ' || category, value, NULL,
         'mortgage-delinquency-rate-canada-provinces-cmas', sub_geography
  FROM spread WHERE province = 'AFRICA'),
alive AS (SELECT *, bool_or(value IS NOT NULL) OVER (PARTITION BY file, sheet, geography) AS keep FROM rows)
SELECT period, CAST(NULL AS VARCHAR) AS sub_geography, category, value, reliability, 'Household Characteristics' AS survey,
       table_id, geography, 'static' AS source FROM alive WHERE keep""")
def matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three workbook layouts in one job."""
    grid, tables = inputs.workbook(spark, sf_dir)
    return matrix.matrix_long(grid, tables).select(*matrix.MATRIX_COLUMNS)


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN CAST(date_trunc('quarter', o_orderdate) AS DATE)
  ELSE CAST(date_trunc('year', o_orderdate) AS DATE) END AS period FROM orders""")
def parse_period_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    date, urgent = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(date, "yyyy"))
        .when(F.col("o_orderstatus") == "P", F.concat(F.date_format(date, "yyyy"), F.lit("Q5")))
        .when(urgent == "1-URGENT", F.date_format(date, "yyyy'Q'q"))
        .when(urgent == "2-HIGH", F.date_format(date, "yyyy/'Q'q"))
        .otherwise(F.date_format(date, "' 'yyyy' Q'q"))
    )
    return orders.select("o_orderkey", fn.parse_grid_period(text).alias("period"))
