from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.operators import analytics, catalogue, geo, lanes, mart, quality

OBS = "survey string, table_id string, geography string, sub_geography string, period date, category string, value double, reliability string, updated_at date"
D, U = date(2025, 10, 1), date(2026, 1, 2)
ROWS = [
    ("Rms", "2.1.11.4", "Toronto", "Guelph-Eramosa (TP)", D, "Total", 1.0, "a", U),
    ("Rms", "2.1.11.4", "Toronto", "Guelph/Eramosa (TP)", D, "Studio", None, None, U),
    ("Rms", "2.1.11.4", "Toronto", "Far (T)", D, "Total", None, "d", U),
    ("Rms", "2.1.11.4", "Toronto", "Listed Only (T)", D, "Total", 4.0, None, U),
    ("Rms", "2.1.11.2", "Ontario", "Toronto", D, "Total", 2.0, "b", U),
    ("Rms", "2.2.11", "Toronto", None, D, "Total", 2.0, "b", U),
    ("Rms", "2.1.31.4", "Ontario", None, D, "Units", 9.0, None, U),
    ("Rms", "2.1.11.2", "Quebec", "Gatineau", D, "Total", 5.0, "a", U),       # unknown place
    ("Scss", "5.7.2", "Ontario", None, D, "Total", 7.0, None, U),             # no rental metric
    ("Rms", "2.1.11.3", "Toronto", "Zone 1", D, "Total", 8.0, "a", U),        # unknown place
]


@pytest.fixture(scope="module")
def frames(spark):
    provinces = spark.createDataFrame([("Ontario",)], "name string")
    metros = spark.createDataFrame([("35535", "0110", "Toronto"), ("35541", "0120", "Kitchener / Waterloo")], "metro_uid string, metro_code string, name string")
    member = "district_uid string, name string, type string, metro_code string"
    members = spark.createDataFrame([
        ("3523009", "Guelph/Eramosa", "TP", "0110"), ("3501", "Far", "T", "9999"), ("3502", "Quiet", "T", "0120"), ("", "", "", "2000"), (None, None, None, "2000"),
    ], member)
    districts = spark.createDataFrame([("3523009", "Guelph/Eramosa", "TP"), ("3599", "Listed Only", "T")], "district_uid string, name string, type string")
    return {"metros": metros, "members": members, "directory": geo.place_directory(provinces, metros, members, districts, province_id=F.lit("ON"))}


@pytest.fixture(scope="module")
def built(spark, frames):
    tables, inventory = catalogue.survey_catalogue(spark), catalogue.metric_inventory(spark)
    return mart.build_mart(
        spark.createDataFrame(ROWS, OBS), metrics=catalogue.metric_dimension(inventory, tables, "Agency"),
        table_map=catalogue.table_metric_map(inventory, tables), directory=frames["directory"], province=F.lit("Ontario"),
    )


def test_fact(built):
    fact = built.rental_observations
    assert fact.columns == list(mart.FACT_COLUMNS) and dict(fact.dtypes)["metric_id"] == "smallint"
    got = {(r.table_id, r.geo_id, r.category, r.value, r.is_suppressed) for r in fact.collect()}
    assert got == {
        ("2.1.11.4", "CSD:3523009", "Total", 1.0, False), ("2.1.11.4", "CSD:3523009", "Studio", None, True),
        ("2.1.11.4", "CSD:3501", "Total", None, False),  # withheld but coded
        ("2.1.11.4", "CSD:Listed Only (T)", "Total", 4.0, False), ("2.1.11.2", "CMA:35535", "Total", 2.0, False),
        ("2.2.11", "CMA:35535", "Total", 2.0, False), ("2.1.31.4", "ON", "Units", 9.0, False),
    }


def test_geographies(built):
    got = {r.geo_id: (r.geo_name, r.geo_level, r.cma, r.csduid, r.cma_uid, r.has_data) for r in built.geographies.collect()}
    assert got == {
        "ON": ("Ontario", "Province", None, None, None, True),
        "CMA:35535": ("Toronto", "CMA", "Toronto", None, "35535", True),
        "CSD:3523009": ("Guelph-Eramosa (TP)", "CSD", "Toronto", "3523009", "35535", True),
        "CSD:3501": ("Far (T)", "CSD", None, "3501", None, True),
        "CSD:Listed Only (T)": ("Listed Only (T)", "CSD", None, None, None, True),
        "CSD:3502": ("Quiet (T)", "CSD", "Kitchener - Waterloo", "3502", "35541", False),
    }
    placed = built.rental_observations.select("geo_id").distinct().count()
    assert placed == sum(v[5] for v in got.values())


def test_dimensions_and_joins(built):
    assert [tuple(r) for r in built.dimension_values.orderBy("sort_order").collect()] == [("Bedroom Type", "Studio", 1), ("Bedroom Type", "Total", 2)]
    assert built.star().count() == built.rental_observations.count()  # dimensions never multiply rows


def test_projections(built):
    specs = {p.name: p for p in mart.projections()}
    assert len(specs) == 25 and "percent_condo_used_as_rental_by_structure_size" in specs
    table = built.tables()["average_rent_by_bedroom"]
    assert table.columns == ["geo_level", "geo_name", "province", "cma", "period", "period_year", "bedroom_type",
                             "avg_rent_dollars", "reliability", "is_suppressed", "source_survey", "table_id", "updated_at"]
    assert table.count() == 6
    assert [tuple(r) for r in mart.published_projections(built.rental_observations, built.metrics).collect()] == [("average_rent_by_bedroom", 6)]


def test_meta(spark, built):
    newest = spark.createDataFrame([(U,)], "source_parquet_newest date")
    meta = mart.meta_row(built.rental_observations, built.geographies, built_at=F.current_timestamp(), source_newest=newest,
                         revision="abc", coverage="%d/%d/%d").collect()
    assert len(meta) == 1
    assert (meta[0].n_observations, meta[0].n_suppressed, meta[0].n_csd_with_data, meta[0].n_csd_no_data, meta[0].n_cma) == (7, 1, 3, 1, 1)
    assert meta[0].coverage_summary == "1/3/1" and meta[0].source_parquet_newest == U and meta[0].portal_commit == "abc"


def test_null_reason(spark):
    df = spark.createDataFrame([(1.0, None), (None, "d"), (None, None)], "v double, r string")
    got = df.select(mart.is_suppressed(F.col("v"), F.col("r")).alias("s"), mart.null_reason(F.col("v"), F.col("r")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(False, "published"), (False, "withheld_with_code"), (True, "withheld_no_code")]


def test_ambiguous_name_takes_first_level(spark):
    provinces = spark.createDataFrame([("Quebec",)], "name string")
    metros = spark.createDataFrame([("1", "1", "Quebec"), ("2", "2", "Hull")], "metro_uid string, metro_code string, name string")
    got = {r.geo_name: (r.geo_level, r.ambiguous) for r in geo.level_universe(provinces, metros).collect()}
    assert got == {"Quebec": ("Province", True), "Hull": ("CMA", False)}


def test_name_lookups(spark):
    df = spark.createDataFrame([("A-B",), ("A/B",), ("C",)], "n string")
    lookup = spark.createDataFrame([("A/B", "1"), ("A-B", "1")], "name string, uid string")
    assert sorted((r.n, r.uid) for r in geo.name_to_uid(df, "n", lookup).collect()) == [("A-B", "1"), ("A/B", "1")]
    names = spark.createDataFrame([("Hull",), ("Hullabaloo",), ("York",), ("hull",)], "name string")
    assert [(r.name, r.rank, r.n_hits) for r in geo.search_names(names, "Hull").collect()] == [("Hull", 0, 1)]
    assert {(r.name, r.n_hits) for r in geo.search_names(names, "ULL").collect()} == {("Hull", 3), ("Hullabaloo", 3), ("hull", 3)}
    places = spark.createDataFrame([("Canada", "1", 0), ("Quebec", "24", 1), ("Quebec", "0420", 2)], "name string, place_id string, tier int")
    wanted = spark.createDataFrame([("Quebec",), ("Atlantis",)], "name string")
    assert {tuple(r) for r in geo.lookup_places(wanted, places).collect()} == {("Quebec", "24", 1), ("Atlantis", None, None)}


def test_latest_is_per_place_and_does_not_fall_back(spark):
    rows = [("a", "x", date(2024, 1, 1), 1.0, "a"), ("a", "x", date(2025, 1, 1), None, None), ("b", "x", date(2020, 1, 1), 3.0, "b"), ("a", "x", None, 9.0, "a")]
    df = spark.createDataFrame(rows, "g string, c string, period date, value double, reliability string")
    got = {tuple(r) for r in analytics.latest_per_group(df, ["g", "c"], ["value", "reliability"]).collect()}
    assert got == {("a", "x", date(2025, 1, 1), None, None), ("b", "x", date(2020, 1, 1), 3.0, "b")}


def test_dedup_and_compare(spark):
    df = spark.createDataFrame([("t", "2.2.11", 1.0), ("t", "2.1.11.2", 1.0), ("u", "2.2.11", 2.0)], "place string, table_id string, v double")
    assert {tuple(r) for r in analytics.dedup_paths(df, ["place"]).collect()} == {("t", 1.0), ("u", 2.0)}
    other = df.where("place = 't'")
    assert {tuple(r) for r in analytics.compare_markets(df, other, ["place"], "v", ("p", "s")).collect()} == {("t", 1.0, 1.0), ("u", 2.0, None)}


def test_bands_and_lanes(spark):
    df = spark.createDataFrame([("Total",), ("Less Than $750",), ("??",)], "category string")
    from tallymart.constants import RENT_BAND_ORDER
    assert {tuple(r) for r in geo.with_band_order(df, "category", RENT_BAND_ORDER).collect()} == {("Total", 7), ("Less Than $750", 1), ("??", 8)}
    a = spark.createDataFrame([(D, None, "c", 1.0, "a", "S", "1", "A/B")], "period date, sub_geography string, category string, value double, reliability string, survey string, table_id string, geography string")
    b = a.select("period", "category", "value", "survey", "table_id", "geography")
    got = lanes.union_lanes({"export": a, "static": b}).collect()
    assert {(r.geography, r.reliability, r.source) for r in got} == {("A-B", "a", "export"), ("A-B", None, "static")}


def test_gates(spark):
    df = spark.createDataFrame([("t1", "g", "c", 1.0), ("t1", "g", "c", 2.0), ("t2", "g", "c", None), ("t2", "g", "d", 1.0), ("t3", "g", "c", 1.0)],
                               "table_id string, g string, category string, value double")
    assert {(r.table_id, r.passes) for r in quality.duplicate_key_gate(df, "table_id", ["g", "category"]).collect()} == {("t1", False), ("t2", True), ("t3", True)}
    assert {(r.table_id, r.passes) for r in quality.null_category_gate(df, "table_id").collect()} == {("t1", True), ("t2", False), ("t3", True)}
    assert [tuple(r) for r in quality.repeated_keys(df, "table_id").orderBy("table_id").collect()] == [("t1", 2), ("t2", 2)]
    left, right = (spark.createDataFrame([(x,) for x in xs], "k string") for xs in ("aab", "bcd"))
    assert tuple(quality.join_coverage(left, right, "k").first()) == (2, 3, 1, 1, 2)
    assert [r.k for r in quality.missing_keys(left, right, "k").collect()] == ["a"]
    log = spark.createDataFrame([("t", "empty"), ("t", "empty"), ("u", "error"), ("v", "ok"), ("v", "error")], "t string, outcome string")
    assert {(r.t, r.verdict) for r in quality.coverage_verdict(log, "t").collect()} == {("t", "suspect_request"), ("u", "dead_table"), ("v", "serving")}


def test_hot_place_plans_have_no_window(spark, built):
    """Groups of any size: latest, dedup, dividers and summary rows are partial aggregates."""
    df = spark.createDataFrame([("a", D, 1.0, "t")], "g string, period date, value double, table_id string")
    for frame in (analytics.latest_per_group(df, ["g"], ["value"]), analytics.dedup_paths(df, ["g"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "partial_" in plan


def test_dimension_values_by_ranges_equal_a_window(spark):
    from pyspark.sql import Window, functions as F

    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 != 0, "big").otherwise(F.concat(F.lit("d"), (F.col("id") % 7).cast("string"))).alias("dimension"),
        F.when(F.col("id") % 997 == 0, F.lit(None)).otherwise(F.format_string("c%05d", "id")).alias("category"))
    rows = rows.unionByName(rows.limit(50)).unionByName(spark.createDataFrame([(None, "x")], "dimension string, category string"))
    got = mart.dimension_values(rows)
    labels = rows.where("dimension is not null").select("dimension", "category").distinct()
    want = labels.select("dimension", "category", F.row_number().over(Window.orderBy("dimension", "category")).cast("smallint").alias("sort_order"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(dimension" in plan.lower()
