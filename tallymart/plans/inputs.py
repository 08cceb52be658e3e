"""Observations, matrices, files and places derived from the given tables.

Each Spark frame has a SQL twin (a CTE) that states the same content directly,
without going through text, so the two sides check each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.constants import METRICS, TIME_SERIES
from tallymart.operators.catalogue import RENTAL_SERIES, SECONDARY_TABLES, survey_catalogue
from tallymart.operators.matrix import recipe_frame
from tallymart.session import local_frame, shared_folder

FLAGS = ("A", "N", "R")
STATUSES = ("F", "O")
CATEGORIES = tuple(f + s for f in FLAGS for s in STATUSES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarter(col: Column) -> Column:
    return F.trunc(col.cast("date"), "quarter")


def cents(col: Column) -> Column:
    """Whole cents of a positive amount (``round`` on doubles would go through BigDecimal)."""
    return F.floor(col * 100 + 0.5)


def mean_value(total: Column, n: Column) -> Column:
    """Mean in units with one decimal, from integer cents: equal in every engine."""
    return F.floor(total / (n * 10)).cast("double") / 10


# --- obs: one reading per supplier, quarter and category -------------------------


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations: nation asked for, supplier inside it; few readings -> suppressed."""
    readings = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            "l_suppkey", quarter(F.col("l_shipdate")).alias("period"),
            F.concat("l_returnflag", "l_linestatus").alias("category"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("l_extendedprice"))).alias("total"))
    )
    n = F.col("n")
    return (
        readings.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lit("Rms").alias("survey"), F.lit("2.1.11.4").alias("table_id"),
            F.col("r_name").alias("province"), F.col("n_name").alias("geography"),
            F.col("s_name").alias("sub_geography"), "period", "category",
            F.when(n > 2, mean_value(F.col("total"), n)).alias("value"),
            F.when(n == 2, "d").when(n == 3, "c").when((n == 4) | (n == 5), "b").when(n > 5, "a").alias("reliability"),
        )
    )


OBS = """obs AS (
  SELECT 'Rms' AS survey, '2.1.11.4' AS table_id, r_name AS province, n_name AS geography,
         s_name AS sub_geography, period, category,
         CASE WHEN n > 2 THEN CAST(floor(total / (n * 10)) AS DOUBLE) / 10 END AS value,
         CASE WHEN n = 1 THEN NULL WHEN n = 2 THEN 'd' WHEN n = 3 THEN 'c' WHEN n <= 5 THEN 'b' ELSE 'a' END AS reliability
  FROM (SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period,
               l_returnflag || l_linestatus AS category, count(*) AS n,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total
        FROM lineitem GROUP BY 1, 2, 3) readings
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

# Every (place, period) by every category, as a wide matrix spells it out.
CELLS = f"""{OBS}, slots AS (
  SELECT DISTINCT province, geography, sub_geography, period FROM obs), cells AS (
  SELECT s.*, c.category, o.value, o.reliability
  FROM slots s CROSS JOIN (SELECT DISTINCT category FROM obs) c
  LEFT JOIN obs o USING (geography, sub_geography, period, category))"""


def obs_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation under two publication paths."""
    base = obs(spark, sf_dir)
    return base.withColumn("table_id", F.explode(F.array(F.col("table_id"), F.lit("2.2.11"))))


OBS_MULTI = f"""{OBS}, obs_multi AS (
  SELECT * FROM obs UNION ALL SELECT * REPLACE ('2.2.11' AS table_id) FROM obs)"""


# --- wide: the same as text cells, each value column followed by its code column ---


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(province, geography, sub_geography, period, AF, AF code, ...), all cells text."""
    cells = []
    for category in CATEGORIES:
        here = f"max(CASE WHEN category = '{category}' THEN"
        cells.append(F.expr(f"{here} CASE WHEN value IS NULL THEN '**' ELSE format_number(value, 1) END END)").alias(category))
        cells.append(F.expr(f"{here} concat(coalesce(reliability, ''), ' ') END)").alias(f"{category} code"))
    # A category that has no column would be lost, so it stops the query.
    listed = F.when(F.col("category").isin(*CATEGORIES), True).otherwise(F.raise_error(F.concat(F.lit("category without a column: "), "category")).cast("boolean"))
    return obs(spark, sf_dir).where(listed).groupBy("province", "geography", "sub_geography", "period").agg(*cells)


# Parts of file lines as SQL text over the columns of ``wide``.


def _quoted(category: str) -> str:
    return f"""'"', coalesce({category}, ''), '",'"""


def _coded(category: str) -> str:
    return f"{_quoted(category)}, coalesce(`{category} code`, ''), ','"


def _labels(tails: tuple[str, ...], gap: str) -> str:
    return ", ".join(f"province, ' catégorie {tail}{gap}'" for tail in tails)


def _line(*parts: str) -> Column:
    return F.expr(f"concat({', '.join(parts)})")


def _text(*lines: Column) -> Column:
    return F.concat_ws("\r\n", *lines)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported table files as bytes, five layouts by region.

    A file covers one supplier over its quarters, or one supplier and quarter; the
    number of files grows with the data, their length does not.
    """
    w, region = wide(spark, sf_dir), F.col("province")
    end = F.lit("\r\n\r\nNotes\r\nSource,Agency\r\n")
    africa, america, asia, europe = (region == r for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE"))

    # A file per supplier, a line per quarter (their number is bounded by the calendar).
    line = F.when(
        africa, _line("date_format(period, 'yyyy')", "'/Q'", "quarter(period)", "','", *map(_coded, CATEGORIES))
    ).otherwise(_line("date_format(period, 'MMM yyyy')", "','", *map(_quoted, CATEGORIES)))
    lines = F.sort_array(F.collect_list(F.struct("period", line.alias("line"))))["line"]
    series = (
        w.where(africa | asia).groupBy("province", "sub_geography").agg(F.concat_ws("\r\n", lines).alias("lines"))
        .select(
            F.when(africa, "2.2.11").otherwise("2.2.1").alias("table_id"), F.col("sub_geography").alias("geography"),
            F.concat(
                F.lit(" Title \r\n1990 to 2024 Row / Apartment\r\n\r\n,"),
                F.when(africa, _line(_labels(CATEGORIES, ",,"))).otherwise(_line(_labels(CATEGORIES, ","))), F.lit("\r\n"),
                F.col("lines"), F.when(asia, "\r\n,1,2,3,4,5,6,").otherwise(""), end,
            ).alias("text"),
        )
    )
    # A file per supplier and quarter.
    subtitle = F.date_format("period", "MMMM yyyy' Row / Apartment'")
    single = w.where(~africa & ~asia).select(
        F.when(america, "2.1.11.4").when(europe, "2.1.11.1").otherwise("3.3.1").alias("table_id"),
        F.concat(F.col("sub_geography"), F.lit(" "), F.date_format("period", "yyyy-MM")).alias("geography"),
        F.concat(
            F.lit(" Title \r\n"),
            F.when(america, _text(
                subtitle, _line("','", _labels(CATEGORIES, ",,")), _line("','", *map(_coded, CATEGORIES)),
            )).when(europe, _text(
                subtitle, _line("','", _labels(STATUSES, ",,")),
                *(_line(f"'Place {f},'", *(_coded(f + s) for s in STATUSES)) for f in FLAGS), F.lit(",1,a ,2,b ,"),
            )).otherwise(_text(
                F.date_format("period", "MMM yyyy"), _line(_labels(CATEGORIES, ",")), _line(*map(_quoted, CATEGORIES)),
            )),
            end,
        ).alias("text"),
    )
    breakdowns = survey_catalogue(spark).select("survey", "table_id", "breakdown")
    return series.unionByName(single).join(breakdowns, "table_id", "left").select(
        "survey", "table_id", "geography", "breakdown", F.encode("text", "ISO-8859-1").alias("content")
    )


FILE_KEYS = ["table_id", "geography"]

# What the files say, stated from the cells.
TIDY = f"""WITH {CELLS}, tidy AS (
  SELECT CASE province WHEN 'AFRICA' THEN '2.2.11' WHEN 'ASIA' THEN '2.2.1' WHEN 'AMERICA' THEN '2.1.11.4'
              WHEN 'EUROPE' THEN '2.1.11.1' ELSE '3.3.1' END AS table_id,
         CASE WHEN province IN ('AFRICA', 'ASIA') THEN sub_geography
              ELSE sub_geography || ' ' || strftime(period, '%Y-%m') END AS geography,
         period,
         CASE WHEN province = 'EUROPE' THEN 'Place ' || category[1] END AS sub_geography,
         province || ' catégorie ' || CASE WHEN province = 'EUROPE' THEN category[2] ELSE category END AS category,
         value,
         CASE WHEN province IN ('AFRICA', 'AMERICA', 'EUROPE') THEN reliability END AS reliability
  FROM cells)"""


# --- workbooks: one file per nation, three layouts by region --------------------


def workbook(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(grid rows, one recipe row per file); a single-sheet file holds one category."""
    w = wide(spark, sf_dir).join(
        table(spark, sf_dir, "supplier").select(F.col("s_name").alias("sub_geography"), "s_suppkey"), "sub_geography"
    )
    # Recipe used by each region's files.
    slugs = {
        "EUROPE": "number-households-core-housing-need",
        "ASIA": "real-average-total-household-income-before-taxes",
        "AFRICA": "mortgage-delinquency-rate-canada-provinces-cmas",
    }
    slug = F.coalesce(
        F.try_element_at(F.create_map(*(F.lit(x) for kv in slugs.items() for x in kv)), F.col("province")),
        F.lit(slugs["EUROPE"]),
    )
    key = ["province", F.col("geography").alias("file")]
    data_row = F.col("s_suppkey") + 10
    first, last = w.agg(F.year(F.min("period")), F.year(F.max("period"))).first()
    quarters = [f"{y}Q{q}" for y in range(first or 0, (last or -1) + 1) for q in range(1, 5)]

    layout = F.when(F.col("province") == "ASIA", "category").when(F.col("province") == "AFRICA", "single").otherwise("period")

    # One sheet per quarter, categories across.
    by_period = w.where(layout == "period").select(
        *key, F.date_format("period", "yyyy'Q'q").alias("sheet"), data_row.alias("row_idx"),
        F.expr(f"array(sub_geography, {', '.join(CATEGORIES)})").alias("cells"),
    )
    # One sheet per category, quarters across with code columns; or a single sheet of one category.
    triples = ", ".join(f"'{c}', {c}, `{c} code`" for c in CATEGORIES)
    long = w.selectExpr(
        "province", "geography", "sub_geography", "s_suppkey", "concat(date_format(period, 'yyyy'), 'Q', quarter(period)) AS quarter",
        f"stack({len(CATEGORIES)}, {triples}) AS (category, text, code)",
    )
    pivoted = long.groupBy("province", "geography", "category", "sub_geography", "s_suppkey").agg(*(
        F.expr(f"max(CASE WHEN quarter = '{q}' THEN struct(text, code) END)").alias(q) for q in quarters
    ))
    by_category = pivoted.where(layout == "category").select(
        *key, F.col("category").alias("sheet"), data_row.alias("row_idx"),
        F.expr(f"array(sub_geography, {', '.join(f'`{q}`.text, `{q}`.code' for q in quarters)})").alias("cells"),
    )
    single = pivoted.where(layout == "single").select(
        "province", F.concat_ws(" ", "geography", "category").alias("file"), F.lit("Sheet1").alias("sheet"), data_row.alias("row_idx"),
        F.expr(f"array(sub_geography, {', '.join(f'`{q}`.text' for q in quarters)})").alias("cells"),
    )
    data = by_period.unionByName(by_category).unionByName(single)

    headers = {
        "period": ["Geography1", *CATEGORIES],
        "category": ["Geography", *(x for q in quarters for x in (q, "Data quality [Note2]"))],
        "single": ["Geography", *quarters],
    }

    def frame_rows(header: list[str]) -> Column:
        rows = [(0, ["Banner"]), (2, header), (9, ["Provinces"]), (10**12, ["Source: somewhere"])]
        listed = ", ".join(f"struct(bigint({i}) AS row_idx, array({', '.join(map(repr, c))}) AS cells)" for i, c in rows)
        return F.expr(f"array({listed})")

    around = data.select("province", "file", "sheet").distinct().select(
        "province", "file", "sheet",
        F.inline(F.when(layout == "category", frame_rows(headers["category"]))
                 .when(layout == "single", frame_rows(headers["single"]))
                 .otherwise(frame_rows(headers["period"]))),
    )
    notes = data.where(layout != "single").select("province", "file").distinct().select(
        "province", "file", F.lit("Notes").alias("sheet"), F.lit(0).cast("bigint").alias("row_idx"),
        F.array(F.lit("ignore me")).alias("cells"),
    )
    grid = data.unionByName(around).unionByName(notes)
    tables = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnRenamed("r_name", "province")
        .withColumn("file", F.explode(
            F.when(layout == "single", F.array(*(F.concat(F.col("n_name"), F.lit(f" {c}")) for c in CATEGORIES)))
            .otherwise(F.array("n_name"))
        ))
        .select("file", slug.alias("slug"))
        .join(recipe_frame(spark), "slug")
        .select(
            "file", F.when(F.col("sheet_dimension").isNull(), "Sheet1").otherwise("Notes").alias("first_sheet"),
            F.lit("Household Characteristics").alias("survey"), F.col("slug").alias("table_id"),
            F.concat(F.lit("Title of "), F.col("file")).alias("title"),
            "axis", "sheet_name", "sheet_dimension", "skip_sheets", "header_marker", "code_label", "metric", "null_tokens",
        )
    )
    # Sheets are read more than once, so they are stored like the workbooks they stand for.
    path = shared_folder(spark, "grid")
    grid.select("file", "sheet", "row_idx", "cells").write.parquet(path)
    return spark.read.parquet(path), tables


# --- market: observations under catalogue ids, for the star ----------------------

# Part size -> publication table; several tables carry the same metric.
TABLE_BY_SIZE = (
    "2.1.1.4", "2.1.1.2", "2.2.1", "2.1.2.4", "2.2.2", "2.1.3.4", "2.1.3.2", "2.1.4.1", "2.1.4.4", "2.1.33.4",
    "2.1.6.4", "2.2.6", "2.1.7.4", "2.1.8.2", "2.1.11.4", "2.1.11.2", "2.2.11", "2.1.11.1", "2.1.13.4", "2.1.15.2",
    "2.1.12.4", "2.1.21.4", "2.1.22.2", "2.1.23.4", "2.1.26.4", "2.1.26.2", "2.1.27.4", "2.1.28.1", "2.1.31.4", "4.2.1",
    "4.4.2", "4.2.3", "4.2.4", "4.2.5", "4.6.1", "4.6.2", "5.7.2", "1.1.1.2", "3.3.1", "7.63",
    "2.2.33", "2.2.31", "2.2.13", "2.2.26", "2.1.1.3", "9.9.9", "2.2.8", "2.2.15", "2.2.22", "2.2.28",
)


def _table_facts(table_id: str) -> tuple[str | None, str | None, int | None, str | None]:
    """(survey, place kind, metric id, dimension) of a table id, for the SQL side."""
    ids = {(survey, series): i for i, (survey, series, *_) in enumerate(METRICS, start=1)}
    head, _, rest = table_id.partition(".")
    if head == "4":
        for series, dimension, tid in SECONDARY_TABLES:
            if tid == table_id:
                return "Srms", "asked", ids["Srms", series], dimension
    if head == "2":
        kind, code, *level = rest.split(".")
        place = {"1": "provinces", "2": "centres", "3": "zones", "4": "districts"}[level[0]] if kind == "1" else "asked"
        for series, dimension, dim_code, _ in RENTAL_SERIES:
            if dim_code == code:
                return "Rms", place, ids["Rms", series], dimension
    return None, None, None, None


def _sql_text(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else f"'{value}'"


_SIZE_ROWS = ",\n    ".join(
    "(" + ", ".join(_sql_text(v) for v in (size, tid, *_table_facts(tid))) + ")"
    for size, tid in enumerate(TABLE_BY_SIZE, start=1)
)


def table_sizes(spark: SparkSession) -> DataFrame:
    return local_frame(spark, enumerate(TABLE_BY_SIZE, start=1), "p_size int, table_id string")


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))


def metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference spelling with slashes; ids are text with leading zeros."""
    key = F.col("n_nationkey").cast("string")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("59"), F.lpad(key, 3, "0")).alias("metro_uid"), F.lpad(key, 4, "0").alias("metro_code"),
        F.translate("n_name", "_", "/").alias("name"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a district; one segment carries metro codes the reference lacks."""
    code = F.lpad(F.col("c_nationkey").cast("string"), 4, "0")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("35"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("district_uid"),
        F.col("c_name").alias("name"), F.lit("T").alias("type"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("9"), code)).otherwise(code).alias("metro_code"),
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of customers, nations and regions, by publication table."""
    published = table_sizes(spark).join(survey_catalogue(spark).select("survey", "table_id", "breakdown"), "table_id", "left")
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(published, "p_size")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    breakdown, nation = F.col("breakdown"), F.translate("n_name", "_", "-")
    asked = (
        F.when(breakdown.isin("Census Subdivision", "Survey Zones", TIME_SERIES) & F.col("survey").isin("Rms", "Srms"), nation)
        .when((breakdown == "Centres") & (F.col("survey") == "Rms"), F.col("r_name"))
        .otherwise("World")
    )
    inside = F.when(F.col("survey") == "Rms",
        F.when(breakdown == "Census Subdivision", F.concat("c_name", F.lit(" (T)")))
        .when(breakdown == "Centres", nation)
        .when(breakdown == "Provinces", F.col("r_name"))
        .when(breakdown == "Survey Zones", F.concat(F.lit("Zone "), "o_orderpriority")))
    grouped = rows.groupBy(
        "survey", "table_id", asked.alias("geography"), inside.alias("sub_geography"),
        quarter(F.col("l_shipdate")).alias("period"), F.concat("l_returnflag", "l_linestatus").alias("category"),
    ).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"),
        F.sum(cents(F.col("l_extendedprice"))).alias("total"), F.max("l_shipdate").cast("date").alias("updated_at"),
    )
    qty = F.col("qty")
    return grouped.select(
        "survey", "table_id", "geography", "sub_geography", "period", "category",
        F.when(qty >= 10, mean_value(F.col("total"), F.col("n"))).alias("value"),
        F.when(qty < 5, None).when(qty < 10, "d").when(qty < 20, "c").when(qty < 35, "b").otherwise("a").alias("reliability"),
        "updated_at",
    )


# Rows the star keeps: known metric and known place.
FACT = f"""sizes(p_size, table_id, source_survey, kind, metric_id, dimension) AS (VALUES
    {_SIZE_ROWS}), grouped AS (
  SELECT source_survey, z.table_id, metric_id, dimension,
         CASE kind WHEN 'districts' THEN 'CSD' WHEN 'provinces' THEN 'Province' WHEN 'zones' THEN NULL ELSE 'CMA' END AS geo_level,
         CASE kind WHEN 'districts' THEN c_name || ' (T)' WHEN 'provinces' THEN r_name
                   ELSE replace(n_name, '_', '-') END AS geo_name,
         CASE kind WHEN 'districts' THEN 'CSD:35' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
                   WHEN 'provinces' THEN 'PR:' || r_name
                   ELSE 'CMA:59' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') END AS geo_id,
         CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period, l_returnflag || l_linestatus AS category,
         sum(l_quantity) AS qty, count(*) AS n,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total,
         CAST(max(l_shipdate) AS DATE) AS updated_at, max(kind) AS kind
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN sizes z USING (p_size)
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE metric_id IS NOT NULL AND kind <> 'zones'
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9), fact AS (
  SELECT CAST(metric_id AS SMALLINT) AS metric_id, geo_id, geo_name, geo_level, kind, period, dimension, category,
         CASE WHEN qty >= 10 THEN CAST(floor(total / (n * 10)) AS DOUBLE) / 10 END AS value,
         CASE WHEN qty < 5 THEN NULL WHEN qty < 10 THEN 'd' WHEN qty < 20 THEN 'c' WHEN qty < 35 THEN 'b' ELSE 'a' END AS reliability,
         qty < 5 AS is_suppressed, source_survey, table_id, updated_at
  FROM grouped)"""

# Districts with their parents, and the geography dimension of the fact.
DISTRICTS = """districts AS (
  SELECT c_name || ' (T)' AS geo_name, '35' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS csduid,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '9' ELSE '' END || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS metro_code,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN replace(n_name, '_', '-') END AS cma,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN '59' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') END AS cma_uid
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

GEOGRAPHIES = f"""{FACT}, {DISTRICTS}, geographies AS (
  SELECT DISTINCT geo_id, geo_name, geo_level, 'Home' AS province,
         CASE geo_level WHEN 'CMA' THEN geo_name END AS cma, CAST(NULL AS VARCHAR) AS csduid,
         CASE geo_level WHEN 'CMA' THEN substr(geo_id, 5) END AS cma_uid, TRUE AS has_data
  FROM fact WHERE geo_level <> 'CSD'
  UNION ALL
  SELECT 'CSD:' || csduid, geo_name, 'CSD', 'Home', cma, csduid, cma_uid,
         geo_name IN (SELECT geo_name FROM fact WHERE geo_level = 'CSD')
  FROM districts)"""
