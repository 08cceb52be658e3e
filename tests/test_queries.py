"""The registry, and a cross-section of queries against their SQL twins on the smallest tables.

``tools/check_oracle.py`` runs all of them on any scale.
"""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tallymart.plans import REGISTRY
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "wide_to_long", "tidy_long", "tidy_long_by_line", "snapshot_long", "matrix_long", "header_row", "csv_cells", "parse_period",
    "parse_number", "star_fact", "geo_dim", "meta_row", "metric_table_average_rent_by_bedroom", "latest_per_group",
    "dedup_row_number", "valid_jobs", "filter_diagnosis", "json_catalogue", "geojson_features", "sink_roundtrip", "log_latency_stream",
    "rejected_files", "headerless_sheets", "workbook_archive", "stored_views", "all_places", "asset_status", "page_lookup", "province_scope",
    "mart_roundtrip", "log_roundtrip", "lookup_roundtrip", "pending_jobs", "build_status_counts", "normalize_name", "subtitle_period",
    "manifest_diff", "stream_pending", "bucketed_latest", "tolerant_names", "needle_search",
)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(REGISTRY) > 100


def test_all_sql_parses(db):
    for name, sql in entry.oracle_sql().items():
        assert db.execute(f"SELECT count(*) FROM ({sql}) q").fetchone()[0] >= 0, name


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["sub_geography", "category", "period"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want
