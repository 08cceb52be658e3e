"""Manifest of a raw tree, rejects per table, and statuses counted by the writing job."""

import os
import time

from pyspark.sql import functions as F

from tallymart.operators import catalogue
from tallymart.operators.matrix import Recipe, recipe_frame
from tallymart.sources import manifest, sinks

BODY = b" T \r\nOctober 2025 Row\r\n\r\n,A,,B,,\r\n1990 October,1,a ,2,b ,\r\n1991 October,3,a ,**,d ,\r\n\r\nNotes\r\n"


def tree(tmp_path):
    root = tmp_path / "raw"

    def put(path, content=BODY):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)

    for path in ("Rms/2.2.11/A.csv", "Rms/2.2.11/B.csv", "Rms/2.2.1/C.csv", "Rms/2.2.1/Broken.csv", "Sr/1.1/D.csv"):
        put(path, b"No data available\r\n" if "Broken" in path else BODY)
    return root, put


def changes(diff):
    return {(r.table_id, r.path.rsplit("/", 1)[1], r.change) for r in diff.changes.collect()}


def later(folder):
    """Move a folder's time on, as a write one second later would."""
    t = os.stat(folder).st_mtime + 1
    os.utime(folder, (t, t))


def test_manifest_diff(spark, tmp_path):
    root, put = tree(tmp_path)
    store = str(tmp_path / "manifest")
    first = manifest.diff(spark, str(root), store)
    assert {c for _, _, c in changes(first)} == {"added"} and len(changes(first)) == 5
    assert sorted(first.listed) == [("Rms", "2.2.1"), ("Rms", "2.2.11"), ("Sr", "1.1")]

    nothing = manifest.diff(spark, str(root), store)
    assert nothing.listed == [] and nothing.changes.count() == 0

    put("Rms/2.2.11/E.csv")  # added
    (root / "Rms/2.2.11/A.csv").unlink()  # removed
    put("Rms/2.2.11/B.csv", BODY + b"more\r\n")  # changed: size
    later(root / "Rms/2.2.11")
    for f in (root / "Sr/1.1").iterdir():
        f.unlink()
    (root / "Sr/1.1").rmdir()
    second = manifest.diff(spark, str(root), store)
    assert second.listed == [("Rms", "2.2.11")]  # the other folders' files are not listed
    assert changes(second) == {("2.2.11", "E.csv", "added"), ("2.2.11", "A.csv", "removed"), ("2.2.11", "B.csv", "changed"), ("1.1", "D.csv", "removed")}
    stored = {r.path.rsplit("/", 1)[1] for r in manifest.files_of(spark, store).collect()}
    assert stored == {"B.csv", "C.csv", "Broken.csv", "E.csv"}


def test_manifest_of_one_survey_keeps_the_others(spark, tmp_path):
    root, put = tree(tmp_path)
    store = str(tmp_path / "manifest")
    manifest.diff(spark, str(root), store)
    put("Sr/1.1/F.csv")
    later(root / "Sr/1.1")
    only = manifest.diff(spark, str(root), store, surveys=["Rms"])
    assert only.listed == [] and only.changes.count() == 0
    rest = manifest.diff(spark, str(root), store)
    assert rest.listed == [("Sr", "1.1")] and changes(rest) == {("1.1", "F.csv", "added"), ("1.1", "D.csv", "same")}


def test_build_by_manifest_equals_build_by_listing(spark, tmp_path):
    root, put = tree(tmp_path)
    tables = catalogue.survey_catalogue(spark)
    by_list, by_manifest = str(tmp_path / "a"), str(tmp_path / "b")
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    plain = sinks.build_archive(spark, str(root), by_list, tables, surveys=["Rms"])
    stored = sinks.build_archive(spark, str(root), by_manifest, tables, surveys=["Rms"], manifest=str(tmp_path / "m"))
    assert key(plain) == key(stored)
    assert key(sinks.read_archive(spark, by_list)) == key(sinks.read_archive(spark, by_manifest))
    time.sleep(1.1)
    put("Rms/2.2.1/Ottawa.csv")
    again = sinks.build_archive(spark, str(root), by_manifest, tables, surveys=["Rms"], manifest=str(tmp_path / "m"))
    assert {(r.table_id, r.status) for r in again.where("status <> 'missing'").collect()} == {("2.2.1", "ok"), ("2.2.11", "skipped")}
    assert sinks.read_archive(spark, by_manifest).where("table_id = '2.2.1'").count() == 8


def test_rejects_of_skipped_tables_stay(spark, tmp_path):
    root, put = tree(tmp_path)
    clean, tables = str(tmp_path / "clean"), catalogue.survey_catalogue(spark)
    store = str(tmp_path / "m")
    sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"], manifest=store)
    assert [(r.table_id, r.geography) for r in sinks.read_rejects(spark, f"{clean}/_rejects").collect()] == [("2.2.1", "Broken")]
    time.sleep(1.1)
    put("Rms/2.2.11/Bad.csv", b"No data available\r\n")
    sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"], manifest=store)
    got = {(r.table_id, r.geography) for r in sinks.read_rejects(spark, f"{clean}/_rejects").collect()}
    assert got == {("2.2.1", "Broken"), ("2.2.11", "Bad")}
    time.sleep(1.1)
    (root / "Rms/2.2.11/Bad.csv").unlink()
    later(root / "Rms/2.2.11")
    sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"], manifest=store)
    got = {(r.table_id, r.geography) for r in sinks.read_rejects(spark, f"{clean}/_rejects").collect()}
    assert got == {("2.2.1", "Broken")}


def books(spark, headed):
    def row(file, i, *cells):
        return (file, "Sheet1", i, [*cells])

    rows = [row("one", 0, "Depots"), row("one", 1, "Geography" if headed else "nothing", "2014Q1"), row("one", 2, "Harbour", "4")]
    grid = spark.createDataFrame(rows, "file string, sheet string, row_idx long, cells array<string>")
    tables = spark.createDataFrame([("one", "Sheet1", "Freight", "t-one", "Depots", "x")],
                                   "file string, first_sheet string, survey string, table_id string, title string, slug string").join(
        recipe_frame(spark, [Recipe("x", "period", header_marker="Geography")]), "slug")
    return grid, tables


def test_first_workbook_build_without_any_header(spark, tmp_path):
    clean = str(tmp_path / "clean")
    status = {(r.table_id, r.status) for r in sinks.build_workbooks(spark, *books(spark, False), clean).collect()}
    assert status == {("t-one", "error")}
    assert [(r.file, r.table_id) for r in sinks.read_rejects(spark, f"{clean}/_rejects").collect()] == [("one", "t-one")]


def test_status_is_that_of_this_build(spark, tmp_path):
    clean = str(tmp_path / "clean")
    assert {r.status for r in sinks.build_workbooks(spark, *books(spark, True), clean).collect()} == {"ok"}
    assert {r.status for r in sinks.build_workbooks(spark, *books(spark, False), clean).collect()} == {"error"}
    assert sinks.read_archive(spark, clean).count() == 1  # former rows stay


def test_written_counts_equal_a_scan(spark, tmp_path):
    clean = str(tmp_path / "clean")
    rows = spark.range(1000).select(
        F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 7).cast("string"))).alias("table_id"),
        F.lit("S").alias("survey"), F.col("id").alias("value"))
    seen = sinks.write_archive(rows, clean)
    stored = sinks.read_archive(spark, clean)
    assert seen["rows"] == stored.count() == 1000
    assert seen["tables"] == {(r.survey, r.table_id) for r in stored.select("survey", "table_id").distinct().collect()}
    assert sinks.write_archive(rows.where("false"), str(tmp_path / "none")) == {"rows": 0, "tables": set()}
