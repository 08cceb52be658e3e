from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymart.constants import TIME_SERIES
from tallymart.operators import catalogue, jobs


@pytest.fixture(scope="module")
def tables(spark):
    return catalogue.survey_catalogue(spark)


@pytest.fixture(scope="module")
def rows(tables):
    return tables.collect()


def test_size_by_survey(rows):
    assert Counter(r.survey for r in rows) == {"Scss": 92, "Rms": 125, "Srms": 7, "Seniors": 10, "Census": 48, "Core Housing Need": 3}
    assert len(rows) == 285


def test_keys_are_unique_and_ids_dotted_digits(rows):
    assert len({(r.survey, r.series, r.dimension, r.breakdown, r.geo_filter) for r in rows}) == len(rows)
    assert all(len(r.table_id.split(".")) >= 2 and all(p.isdigit() for p in r.table_id.split(".")) for r in rows)


def find(tables, **wanted):
    return catalogue.find_tables(tables, **wanted).collect()


def test_find(tables):
    vacancy = find(tables, survey="Rms", series="Vacancy Rate")
    assert vacancy and {(r.survey, r.series) for r in vacancy} == {("Rms", "Vacancy Rate")}
    assert [r.table_id for r in find(tables, survey="Scss", series="Starts", dimension="Dwelling Type", breakdown=TIME_SERIES, geo_filter="All")] == ["5.7.2"]
    assert [r.table_id for r in find(tables, survey="Scss", series="Length of Construction", dimension="Intended Market", breakdown=TIME_SERIES)] == ["1.2.8"]
    assert {r.dimension for r in find(tables, survey="Scss", series="Share absorbed at completion")} == {"Dwelling Type"}
    assert {r.series for r in find(tables, survey="Scss")} == {
        "Starts", "Completions", "Under Construction", "Length of Construction", "Absorbed Units",
        "Share absorbed at completion", "Unabsorbed Inventory"}
    assert len(find(tables)) == 285
    with pytest.raises(TypeError):
        catalogue.find_tables(tables, colour="x")


@pytest.mark.parametrize("key, table_id", [
    (("Scss", "Starts", "Dwelling Type", "Provinces", "Default"), "1.1.1.2"),
    (("Scss", "Starts", "Intended Market", "Census Tracts", "Default"), "1.4.1.11"),
    (("Scss", "Unabsorbed Inventory", "Dwelling Type", "Survey Zones", "Default"), "1.1.4.6"),
    (("Scss", "Under Construction", "Intended Market", TIME_SERIES, "Default"), "1.9.3"),
    (("Scss", "Under Construction", "Intended Market", TIME_SERIES, "10k"), "1.9.3.6"),
    (("Rms", "Average Rent", "Bedroom Type", "Census Subdivision", "Default"), "2.1.11.4"),
    (("Rms", "Summary Statistics", None, "Survey Zones", "Default"), "2.1.31.3"),
    (("Rms", "Vacancy Rate", "Rent Quartiles", TIME_SERIES, "Default"), "2.2.33"),
    (("Seniors", "Universe and Number of Residents", "Spaces and Residents", "Snapshot", "Default"), "3.1.2"),
    (("Seniors", "Heavy Care Spaces", "Vacancy Rate and Average Rent", TIME_SERIES, "Default"), "3.8.3"),
    (("Census", "Mobility 1 of 65 and over", "Age of Primary Household Maintainer", "Census Tracts", "Default"), "7.10.5"),
    (("Census", "65 and over", "Age of Population", TIME_SERIES, "Default"), "6.98"),
    (("Core Housing Need", "Housing Standards", "Households in Core Housing Need", TIME_SERIES, "Default"), "7.15"),
])
def test_ids(rows, key, table_id):
    assert {(r.survey, r.series, r.dimension, r.breakdown, r.geo_filter): r.table_id for r in rows}[key] == table_id


def test_filters(rows):
    rental = [r for r in rows if r.survey == "Rms"]
    assert all(("season" in r.filters) == (r.breakdown == TIME_SERIES) for r in rental)
    assert not any("bedroom_count_type_desc_en" in r.filters for r in rental)
    assert {tuple(r.filters) for r in rows if r.survey in ("Srms", "Seniors")} == {()}


def test_metrics(spark, tables):
    inventory = catalogue.metric_inventory(spark)
    metrics = {r.metric_name: r for r in catalogue.metric_dimension(inventory, tables, "Agency").collect()}
    assert len(metrics) == 14 and metrics["Average Rent"].metric_id == 3
    assert metrics["Average Rent Change"].source_table_ids == "2.1.12.1, 2.1.12.2, 2.1.12.3, 2.1.12.4, 2.1.12.5, 2.1.12.6, 2.2.12"
    assert metrics["Condo Universe"].description == "Condo Universe from Agency Srms"
    none = catalogue.metric_dimension(inventory, tables.where(F.col("survey") == "Rms"), "Agency")
    assert none.where("metric_name = 'Condo Universe'").first().source_table_ids == ""
    mapped = catalogue.table_metric_map(inventory, tables)
    assert mapped.count() == 132 == mapped.select("table_id").distinct().count()
    assert mapped.where("table_id = '2.1.31.3'").first().dimension is None
    assert dict(mapped.dtypes)["metric_id"] == "smallint"


# --- jobs -------------------------------------------------------------------------

PLACES = [("Home", "1", 1, None), ("Prov", "35", 2, None), ("Metro", "0110", 3, None), ("In", "3520005", 4, "35"),
          ("Out", "3501005", 4, "35"), ("Elsewhere", "2400001", 4, "24"), ("Tract", "1.01", 7, "35"), ("Zone", "z", 5, "35")]


@pytest.fixture(scope="module")
def places(spark):
    frame = spark.createDataFrame(PLACES, "place string, geography_id string, level int, province_code string")
    members = spark.createDataFrame([("3520005",)], "geography_id string")
    listed = spark.createDataFrame([("35",)], "province_code string")
    return jobs.place_classes(frame, members, listed)


def expected(table_id, breakdown, geo_filter, place, level):
    """Validity, restated one pair at a time."""
    if table_id in ("1.16.3.4", "1.16.3.5"):
        return False
    sub = breakdown in ("Survey Zones", "Census Subdivision", "Neighbourhoods", "Census Tracts")
    parent = breakdown in ("Provinces", "Centres")
    if level == 1:
        return not sub and (parent or geo_filter in ("All", "10k", "50k", "Metro"))
    if level == 2:
        return breakdown == "Centres" and geo_filter == "Default"
    if level == 3:
        return not parent and not sub and geo_filter == "Default"
    if level in (4, 7):
        blocked = place == "Out" and breakdown in ("Survey Zones", "Neighbourhoods", "Census Tracts")
        return not parent and not blocked and geo_filter == "Default"
    return False


def test_valid_jobs_equal_pairwise_rule(tables, rows, places):
    got = {(r.table_id, r.place) for r in jobs.valid_jobs(tables, places).collect()}
    want = {(r.table_id, p) for r in rows for p, _, level, _ in PLACES if expected(r.table_id, r.breakdown, r.geo_filter, p, level)}
    assert got == want
    some = jobs.valid_jobs(tables, places, ["Srms"]).select("survey").distinct().collect()
    assert [r.survey for r in some] == ["Srms"]


def test_pending_jobs_retry_old_markers(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "job string")
    done = spark.createDataFrame([("a",)], "job string")
    empties = spark.createDataFrame([("b", 1), ("c", 90)], "job string, age int")
    assert {r.job for r in jobs.pending_jobs(frame, done, empties, ["job"]).collect()} == {"d"}
    assert {r.job for r in jobs.pending_jobs(frame, done, empties, ["job"], F.col("age") < 30).collect()} == {"c", "d"}


def test_filter_variants(spark):
    frame = spark.createDataFrame([("S", "1", {"a": ["x"], "b": ["y"]}), ("S", "2", {})],
                                  "survey string, table_id string, filters map<string,array<string>>")
    got = {(r.table_id, r.variant, r.removed, tuple(sorted(r.applied))) for r in jobs.filter_variants(frame).collect()}
    assert got == {("1", "bare", None, ()), ("1", "all", None, ("a", "b")), ("1", "minus", "a", ("b",)),
                   ("1", "minus", "b", ("a",)), ("2", "bare", None, ())}


def test_diagnosis(spark):
    def case(name, bare, full, **minus):
        return [(name, "bare", None, bare), (name, "all", None, full), *((name, "minus", k, v) for k, v in minus.items())]

    rows = (case("culprit", "ok", "empty", a="ok", b="empty") + case("stuck", "ok", "empty", a="empty")
            + case("dead", "http_500", "http_500", a="empty") + case("fine", "ok", "ok", a="ok")
            + case("two", "ok", "empty", b="ok", a="ok"))
    frame = spark.createDataFrame(rows, "t string, variant string, removed string, outcome string")
    got = {r.t: (r.verdict, r.culprits) for r in jobs.diagnose_filters(frame, ["t"]).collect()}
    assert got == {"culprit": ("filter_breaks_request", "a"), "stuck": ("no_single_filter_recovers", ""),
                   "dead": ("bare_request_fails", ""), "fine": ("filters_work", ""), "two": ("filter_breaks_request", "a, b")}


def test_second_pass_and_summary(spark):
    schema = "page_url string, assets array<string>"
    first = spark.createDataFrame([("p1", ["a", "b"]), ("p2", []), ("p3", [])], schema)
    later = spark.createDataFrame([("p2", ["c"])], schema)
    filled = catalogue.fill_from_second_pass(first, later)
    assert {(r.page_url, tuple(r.assets), r.discovery) for r in filled.collect()} == {
        ("p1", ("a", "b"), "html"), ("p2", ("c",), "render"), ("p3", (), None)}
    assert tuple(catalogue.discovery_summary(filled).first()) == (3, 2, 3, 1, 1)
