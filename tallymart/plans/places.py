"""Join queries: places, hierarchies, planned jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.constants import DEAD_TABLE_IDS, METRO_SCOPED_BREAKDOWNS, NATIONAL_GEO_FILTERS, SUB_METRO_BREAKDOWNS
from tallymart.operators import analytics, catalogue, geo, jobs, names, quality
from tallymart.plans import inputs
from tallymart.plans.inputs import DISTRICTS, OBS
from tallymart.plans.registry import query
from tallymart.session import local_frame, shared_folder
from tallymart.sources.sinks import folder_exists
from tallymart.streaming import attempts


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query(f"WITH {DISTRICTS} SELECT geo_name, csduid, metro_code, cma, cma_uid FROM districts")
def hierarchy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District -> metro code -> metro name and uid; codes the reference lacks give null."""
    return geo.district_parents(inputs.members(spark, sf_dir), inputs.metros(spark, sf_dir)).select(
        "geo_name", "csduid", "metro_code", "cma", "cma_uid"
    )


@query("""SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differently named keys; rows without a partner stay."""
    customers = inputs.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = inputs.table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customers = inputs.table(spark, sf_dir, "customer")
    return customers.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference members the data has nothing on."""
    urgent = inputs.table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    seen = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return quality.missing_keys(inputs.table(spark, sf_dir, "customer"), seen, "c_custkey")


@query("""SELECT c_custkey, replace(n_name, '_', '-') AS printed, '59' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS uid
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def name_to_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names printed with hyphens meet a reference that spells them with slashes."""
    places = inputs.table(spark, sf_dir, "customer").join(
        inputs.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.translate("n_name", "_", "-").alias("printed"))
    lookup = inputs.metros(spark, sf_dir).select("name", F.col("metro_uid").alias("uid"))
    return geo.name_to_uid(places, "printed", lookup)


@query("""WITH w AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN n_name WHEN '2-HIGH' THEN r_name WHEN '3-MEDIUM' THEN 'World'
              WHEN '4-NOT SPECIFIED' THEN 'Atlantis' ELSE c_name END AS name, n_nationkey, r_regionkey, o_orderpriority AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT o_orderkey, name, CASE p WHEN '1-URGENT' THEN 'M' || n_nationkey WHEN '2-HIGH' THEN 'P' || r_regionkey WHEN '3-MEDIUM' THEN '1' END AS place_id,
  CAST(CASE p WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 0 END AS INTEGER) AS tier FROM w""")
def place_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country, then provinces, then metros; unknown names keep a null id."""
    nation, region = inputs.table(spark, sf_dir, "nation"), inputs.table(spark, sf_dir, "region")
    places = (
        region.select(F.col("r_name").alias("name"), F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("place_id"), F.lit(1).alias("tier"))
        .unionByName(nation.select(F.col("n_name").alias("name"), F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("place_id"), F.lit(2).alias("tier")))
        .unionByName(region.select(F.lit("World").alias("name"), F.lit("1").alias("place_id"), F.lit(0).alias("tier")).distinct())
    )
    kind = F.col("o_orderpriority")
    wanted = (
        inputs.table(spark, sf_dir, "orders")
        .join(inputs.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", F.when(kind == "1-URGENT", F.col("n_name")).when(kind == "2-HIGH", F.col("r_name"))
                .when(kind == "3-MEDIUM", "World").when(kind == "4-NOT SPECIFIED", "Atlantis").otherwise(F.col("c_name")).alias("name"))
    )
    return geo.lookup_places(wanted, places)


@query(f"""WITH {OBS}, d AS (SELECT sub_geography, period, category, max(value) AS value FROM obs GROUP BY 1, 2, 3)
SELECT f.sub_geography, f.period, f.value AS primary_value, o.value AS secondary_value
FROM (SELECT * FROM d WHERE category = 'AF') f LEFT JOIN (SELECT * FROM d WHERE category = 'RO') o USING (sub_geography, period)""")
def compare_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two markets side by side; both come under two publication paths and are reduced first."""
    multi = inputs.obs_multi(spark, sf_dir)
    keys = ["sub_geography", "period"]
    primary, secondary = (multi.where(F.col("category") == c) for c in ("AF", "RO"))
    return analytics.compare_markets(primary, secondary, keys, "value", ("primary_value", "secondary_value"))


@query(f"""WITH {OBS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sub_geography ORDER BY period DESC) AS rn FROM obs
  WHERE category = 'AF' AND value IS NOT NULL)
SELECT 'S' || s_suppkey AS uid, s_acctbal AS area, value, CASE WHEN rn = 1 THEN strftime(period, '%b %Y') END AS period
FROM supplier LEFT JOIN (SELECT * FROM ranked WHERE rn = 1 AND reliability IN ('a', 'b')) r ON sub_geography = s_name""")
def choropleth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary features with the latest confident value; features without one stay uncoloured."""
    suppliers = inputs.table(spark, sf_dir, "supplier")
    features = suppliers.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("uid"), F.col("s_acctbal").alias("area"))
    names = suppliers.select(F.col("s_name").alias("name"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("uid"))
    published = inputs.obs(spark, sf_dir).where((F.col("category") == "AF") & F.col("value").isNotNull())
    latest = analytics.latest_per_group(published, ["sub_geography"], ["value", "reliability"])
    coloured = geo.name_to_uid(analytics.high_confidence(latest), "sub_geography", names)
    shown = coloured.select("uid", "value", F.date_format("period", "MMM yyyy").alias("period"))
    return geo.choropleth(features, shown, "uid")


@query("""SELECT o_orderpriority AS category, count(*) AS n, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2
  WHEN '3-MEDIUM' THEN 3 ELSE 5 END AS INTEGER) AS band_order FROM orders GROUP BY 1""")
def band_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display order by a list; bands it does not name come last, bands without rows do not show."""
    bands = inputs.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return geo.with_band_order(bands, "category", ["5-LOW", "1-URGENT", "3-MEDIUM", "0-ABSENT"])


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
 b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0)
SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, (SELECT count(*) FROM a JOIN b USING (k)) AS n_matched,
  (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS n_left_only, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS n_right_only""")
def join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = inputs.table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("k"))
    right = inputs.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("k"))
    return quality.join_coverage(left, right, "k")


# --- planning ---------------------------------------------------------------------

# Part type -> (code set of its breakdowns); types not listed are national tables.
_CODE_SETS = {"ECONOMY": "wide", "SMALL": "wide", "MEDIUM": "wide", "LARGE": "narrow", "PROMO": "narrow"}
_CODES = (
    ("wide", "Provinces", "1"), ("wide", "Centres", "2"), ("wide", "Survey Zones", "3"), ("wide", "Census Subdivision", "4"),
    ("wide", "Neighbourhoods", "5"), ("wide", "Census Tracts", "6"), ("narrow", "Survey Zones", "3"), ("narrow", "Census Subdivision", "4"),
)


def plan_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part brands stand for series, types for dimensions: ids are expanded by rule."""
    kinds = F.create_map(*(F.lit(x) for kv in _CODE_SETS.items() for x in kv))
    code_set = F.try_element_at(kinds, F.col("dimension"))
    series = inputs.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("series"), F.col("p_type").alias("dimension")
    ).distinct()
    fixed = code_set.isNull()
    specs = series.select(
        F.lit("Rms").alias("survey"), "series", "dimension",
        F.concat(F.lit("2."), F.replace("series", F.lit("Brand#"), F.lit("")), F.lit("."), F.length("dimension").cast("string")).alias("id_prefix"),
        code_set.alias("code_set"),
        F.when(fixed, "Historical Time Periods").alias("breakdown"),
        F.when(fixed & F.col("series").endswith("5"), "All").otherwise("Default").alias("geo_filter"),
        F.create_map(F.lit("brand"), F.array("series"), F.lit("kind"), F.array("dimension", F.lit("Total"))).alias("filters"),
    )
    codes = local_frame(spark, _CODES, "code_set string, breakdown string, code string")
    overrides = series.where((F.col("series") == "Brand#1") & (F.col("dimension") == "STANDARD")).select(
        F.lit("Rms").alias("survey"), "series", "dimension", F.lit("Historical Time Periods").alias("breakdown"),
        F.lit(DEAD_TABLE_IDS[0]).alias("table_id"),
    )
    return catalogue.expand_catalogue(specs, codes, overrides)


_PLAN = f"""codes(code_set, breakdown, code) AS (VALUES {', '.join(str(c) for c in _CODES)}), plan AS (
  SELECT 'Rms' AS survey, p_brand AS series, p_type AS dimension, coalesce(breakdown, 'Historical Time Periods') AS breakdown,
         CASE WHEN code IS NULL AND p_brand = 'Brand#1' THEN '{DEAD_TABLE_IDS[0]}'
              ELSE '2.' || replace(p_brand, 'Brand#', '') || '.' || length(p_type) || coalesce('.' || code, '') END AS table_id,
         CASE WHEN code IS NULL AND p_brand LIKE '%5' THEN 'All' ELSE 'Default' END AS geo_filter
  FROM (SELECT DISTINCT p_brand, p_type FROM part) p LEFT JOIN codes
    ON code_set = CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') THEN 'wide' WHEN p_type IN ('LARGE', 'PROMO') THEN 'narrow' END)"""


@query(f"WITH {_PLAN} SELECT survey, series, dimension, breakdown, table_id, geo_filter, 'brand' AS first_filter FROM plan")
def catalogue_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs fan out over the codes of their set, single ids are overridden."""
    return plan_catalogue(spark, sf_dir).select(
        "survey", "series", "dimension", "breakdown", "table_id", "geo_filter",
        F.get(F.array_sort(F.map_keys("filters")), F.lit(0)).alias("first_filter"),
    )


@query(f"""WITH {_PLAN} SELECT table_id, 'bare' AS variant, '' AS removed, '' AS applied FROM plan
UNION ALL SELECT table_id, 'all', '', 'brand=' || series || ';kind=' || dimension || ',Total' FROM plan
UNION ALL SELECT table_id, 'minus', 'brand', 'kind=' || dimension || ',Total' FROM plan
UNION ALL SELECT table_id, 'minus', 'kind', 'brand=' || series FROM plan""")
def filter_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare, full and leave-one-out variants of each table's request filters."""
    entries = F.transform(
        F.map_entries("applied"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))
    )
    return jobs.filter_variants(plan_catalogue(spark, sf_dir)).select(
        "table_id", "variant", F.coalesce("removed", F.lit("")).alias("removed"),
        F.array_join(F.array_sort(entries), ";").alias("applied"),
    )


def plan_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country, regions as provinces, nations as metros, suppliers as districts or tracts."""
    region, nation, supplier = (inputs.table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))

    def place(name, code, level, province) -> list:
        return [name.alias("place"), code.alias("geography_id"), level.cast("int").alias("level"), province.alias("province_code")]

    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    return (
        region.select(*place(F.lit("World"), F.lit("1"), F.lit(1), none)).distinct()
        .unionByName(region.select(*place(F.col("r_name"), text("r_regionkey"), F.lit(2), none)))
        .unionByName(nation.select(*place(F.col("n_name"), text("n_nationkey"), F.lit(3), none)))
        .unionByName(supplier.select(*place(F.col("s_name"), text("s_suppkey"), F.when(F.col("s_acctbal") < 0, 7).otherwise(4), text("s_nationkey"))))
    )


def _members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    supplier = inputs.table(spark, sf_dir, "supplier")
    inside = supplier.where(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").cast("string").alias("geography_id"))
    listed = inputs.table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0).select(F.col("n_nationkey").cast("string").alias("province_code"))
    return inside, listed


def plan_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = jobs.place_classes(plan_places(spark, sf_dir), *_members(spark, sf_dir))
    return jobs.valid_jobs(plan_catalogue(spark, sf_dir), classified)


_JOBS = f"""{_PLAN}, spots AS (
  SELECT DISTINCT 'World' AS place, '1' AS geography_id, 1 AS level, FALSE AS outside FROM region
  UNION ALL SELECT r_name, CAST(r_regionkey AS VARCHAR), 2, FALSE FROM region
  UNION ALL SELECT n_name, CAST(n_nationkey AS VARCHAR), 3, FALSE FROM nation
  UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal < 0 THEN 7 ELSE 4 END,
    n_regionkey = 0 AND s_acctbal <= 5000 FROM supplier JOIN nation ON s_nationkey = n_nationkey), jobs AS (
  SELECT place, level, table_id FROM plan CROSS JOIN spots
  WHERE table_id NOT IN {_in(DEAD_TABLE_IDS)} AND CASE level
    WHEN 1 THEN breakdown NOT IN {_in(SUB_METRO_BREAKDOWNS)} AND (breakdown IN ('Provinces', 'Centres') OR geo_filter IN {_in(NATIONAL_GEO_FILTERS)})
    WHEN 2 THEN breakdown = 'Centres' AND geo_filter = 'Default'
    WHEN 3 THEN breakdown NOT IN ('Provinces', 'Centres') AND breakdown NOT IN {_in(SUB_METRO_BREAKDOWNS)} AND geo_filter = 'Default'
    WHEN 4 THEN breakdown NOT IN ('Provinces', 'Centres') AND NOT (outside AND breakdown IN {_in(METRO_SCOPED_BREAKDOWNS)}) AND geo_filter = 'Default'
    ELSE breakdown NOT IN ('Provinces', 'Centres') AND geo_filter = 'Default' END)"""


@query(f"WITH {_JOBS} SELECT place, level, table_id FROM jobs")
def valid_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables meet places on the place's class, so invalid pairs never arise."""
    return plan_jobs(spark, sf_dir).select("place", "level", "table_id")


_TRIED = """tried AS (SELECT DISTINCT s_name AS place, '2.' || replace(p_brand, 'Brand#', '') || '.' || length(p_type) || '.4' AS table_id,
    l_returnflag AS flag, max(l_shipdate) AS tried_at FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""


@query(f"""WITH {_JOBS}, {_TRIED} SELECT place, table_id FROM jobs
WHERE (place, table_id) NOT IN (SELECT (place, table_id) FROM tried WHERE flag = 'A')
  AND (place, table_id) NOT IN (SELECT (place, table_id) FROM tried WHERE flag = 'N' AND tried_at >= TIMESTAMP '1999-01-01')""")
def pending_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs neither done nor known empty; empty markers from before 1999 are tried again."""
    tried = (
        inputs.table(spark, sf_dir, "lineitem")
        .join(inputs.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(inputs.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("s_name").alias("place"),
            F.concat_ws(".", F.lit("2"), F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.length("p_type").cast("string"), F.lit("4")).alias("table_id"),
            "l_returnflag",
        )
        .agg(F.max("l_shipdate").cast("date").alias("tried_at"))
    )
    done, empties = (tried.where(F.col("l_returnflag") == f) for f in ("A", "N"))
    fresh = F.col("tried_at") >= F.lit("1999-01-01").cast("date")
    return jobs.pending_jobs(plan_jobs(spark, sf_dir), done, empties, ["place", "table_id"], fresh).select("place", "table_id")


@query(f"""WITH {_JOBS}, {_TRIED}, newest AS (SELECT max(l_shipdate) AS at FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
SELECT place, table_id FROM jobs
WHERE (place, table_id) NOT IN (SELECT (place, table_id) FROM tried WHERE flag = 'A')
  AND (place, table_id) NOT IN (SELECT (place, table_id) FROM tried, newest WHERE flag = 'N' AND tried_at >= newest.at - INTERVAL 395 DAY)""")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending jobs from the attempt log read as a stream: keyed state per (place, table), empty markers expire by timer.

    Every shipped line is an attempt (A: ok, N: empty, else an error); the watermark trails
    by 30 days and an empty answer counts for 365 days after it.
    """
    log, out, checkpoint = (shared_folder(spark, p) for p in ("attempts", "statuses", "attempts-checkpoint"))
    outcome = F.when(F.col("l_returnflag") == "A", "ok").when(F.col("l_returnflag") == "N", "empty").otherwise("error")
    (
        inputs.table(spark, sf_dir, "lineitem")
        .join(inputs.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(inputs.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("s_name").alias("place"),
            F.concat_ws(".", F.lit("2"), F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.length("p_type").cast("string"), F.lit("4")).alias("table_id"),
            outcome.alias("outcome"), F.col("l_shipdate").cast("timestamp").alias("tried_at"),
        )
        .write.parquet(log)
    )
    attempts.stream_statuses(spark, log, out, checkpoint, delay="30 days", ttl_ms=365 * 86_400_000).awaitTermination()
    if not folder_exists(spark, out):  # an empty log changes no status
        return plan_jobs(spark, sf_dir).select("place", "table_id")
    known = attempts.latest_statuses(spark, out).where(F.col("status") != "pending")
    return plan_jobs(spark, sf_dir).join(known, ["place", "table_id"], "left_anti").select("place", "table_id")


_TYPO = """CASE s_suppkey % 3
    WHEN 0 THEN substr(s_name, 1, s_suppkey % 9) || substr(s_name, s_suppkey % 9 + 2)
    WHEN 1 THEN substr(s_name, 1, s_suppkey % 7 + 2) || 'x' || substr(s_name, s_suppkey % 7 + 4)
    ELSE s_name END"""


@query(f"""WITH q AS (SELECT DISTINCT lower(trim({_TYPO})) AS query FROM supplier WHERE trim({_TYPO}) <> ''),
l AS (SELECT DISTINCT lower(trim(s_name)) AS known, s_suppkey AS uid FROM supplier),
c AS (SELECT query, uid, levenshtein(query, known) AS d FROM q, l
      WHERE levenshtein(query, known) <= least(CASE WHEN length(query) >= 8 THEN 2 WHEN length(query) >= 4 THEN 1 ELSE 0 END,
                                               CASE WHEN length(known) >= 8 THEN 2 WHEN length(known) >= 4 THEN 1 ELSE 0 END)),
b AS (SELECT query, d, count(DISTINCT uid) AS n_best, min(uid) AS uid FROM c WHERE (query, d) IN (SELECT (query, min(d)) FROM c GROUP BY query) GROUP BY query, d)
SELECT q.query, CASE WHEN n_best = 1 THEN b.uid END AS uid, b.d AS distance, COALESCE(n_best, 0) AS n_best, COALESCE(n_best > 1, FALSE) AS ambiguous
FROM q LEFT JOIN b USING (query)""")
def tolerant_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier names with a typing error in two of three (a letter dropped or replaced) found again by tolerant matching."""
    supplier = inputs.table(spark, sf_dir, "supplier")
    typed = supplier.select(F.expr(_TYPO).alias("name"))
    return names.tolerant_uids(typed, "name", supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("uid")))


_NEEDLE = "substr(split_part(p_name, ' ', 1), 2, p_partkey % 5)"


@query(f"""WITH n AS (SELECT DISTINCT {_NEEDLE} AS needle FROM part WHERE p_partkey % 5 > 0), h AS (SELECT DISTINCT p_name AS name FROM part)
SELECT needle, name, CASE WHEN lower(name) = lower(needle) THEN 0 ELSE 1 END AS rank FROM n, h WHERE contains(lower(name), lower(needle))""")
def needle_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of one to four letters of part names, each found in every part name that holds it."""
    part = inputs.table(spark, sf_dir, "part")
    return names.search_many(part.select(F.col("p_name").alias("name")), part.select(F.expr(_NEEDLE).alias("needle")))
