import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart.operators import catalogue, geo, mart, tidy
from tallymart.sources import files, geojson, sinks
from tallymart.streaming import stream_archive, stream_latency

BODY = b" T \r\nOctober 2025 Row\r\n\r\n,A,,B,,\r\n1990 October,1,a ,2,b ,\r\n1991 October,3,a ,**,d ,\r\n\r\nNotes\r\n"


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"

    def put(path, content=BODY):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)

    put("Rms/2.2.11/St._John's.csv")
    put("Rms/2.2.11/Guelph-Eramosa_(TP).csv")
    put("Rms/2.2.1/Toronto.csv")
    put("Rms/2.2.1/Broken.csv", b"No data available\r\n")
    put("Rms/loose.csv")
    put("Rms/2.2.11/old/Deep.csv")
    put("other/tables/x.csv")
    put("Rms/2.2.11/notes.txt")
    return root, put


def test_raw_tree(spark, raw):
    root, _ = raw
    got = {(r.survey, r.table_id, r.geography) for r in files.raw_files(spark, str(root), ["Rms"]).collect()}
    assert got == {("Rms", "2.2.11", "St. John's"), ("Rms", "2.2.11", "Guelph-Eramosa (TP)"), ("Rms", "2.2.1", "Toronto"), ("Rms", "2.2.1", "Broken")}
    assert files.raw_files(spark, str(root)).where("survey = 'other'").count() == 1


def test_listing_reads_no_content(spark, raw):
    plan = files.raw_files(spark, str(raw[0])).select("path", "modificationTime")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan


def test_lines_are_numbered_across_splits(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for name in ("a", "b c+d"):
        (folder / f"{name}.csv").write_bytes(b"".join(b"%s line %d \xe9\r\n" % (name.encode(), i) for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = files.raw_lines(spark, str(folder))
        assert lines.select(F.spark_partition_id()).distinct().count() >= 1
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.path.rsplit("/", 1)[1] for r in rows} == {"a.csv", "b c+d.csv"}
    for name in ("a", "b c+d"):
        mine = sorted((r.pos, r.line) for r in rows if r.path.endswith(f"/{name}.csv"))
        assert mine == [(i, f"{name} line {i} é") for i in range(3000)]
    assert files.raw_lines(spark, str(folder), larger_than=10**9).count() == 0


def test_both_lanes_give_the_same_archive(spark, raw):
    root, _ = raw
    tables = catalogue.survey_catalogue(spark)
    small = sinks.tidy_tree(spark, str(root), tables, surveys=["Rms"])
    large = sinks.tidy_tree(spark, str(root), tables, surveys=["Rms"], row_lane_bytes=0)
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert key(small.long) == key(large.long) and small.long.count() == 12
    assert key(small.rejects.drop("path")) == key(large.rejects.drop("path"))
    assert [r.geography for r in large.rejects.collect()] == ["Broken"]


MARK = b"\xef\xbb\xbf"


def test_lanes_agree_on_marks_and_line_ends(spark, tmp_path):
    table = [b",A,,B,,", b"1990 October,1,a ,2,b ,", b"1991 October,3,a ,**,d ,"]
    bodies = {
        "mark": MARK + b"\r\n".join(table), "titled": MARK + b"T\r\n" + b"\r\n".join(table), "lf": b"\n".join([b"T", *table]), "cr": b"\r".join([b"T", *table, b""]),
        "crlf": b"\r\n".join([b"T", *table]), "none": b"T\r\nnothing here\r\n", "empty": b"\r\n", "marked_none": MARK + b"T\r\n",
    }
    folder = tmp_path / "raw" / "Rms" / "2.2.1"
    folder.mkdir(parents=True)
    for name, body in bodies.items():
        (folder / f"{name}.csv").write_bytes(body)
    tables = catalogue.survey_catalogue(spark)
    lanes = [sinks.tidy_tree(spark, str(tmp_path / "raw"), tables, row_lane_bytes=n) for n in (10**6, 0)]
    rows, lines = ({(r.geography, r.period, r.category, r.value, r.reliability) for r in lane.long.collect()} for lane in lanes)
    assert rows == lines
    assert {r[0] for r in rows} == {"mark", "titled", "lf", "cr", "crlf"} and len(rows) == 20
    rows, lines = ({(r.geography, r.reason) for r in lane.rejects.collect()} for lane in lanes)
    assert rows == lines and {r[0] for r in rows} == {"none", "empty", "marked none"}


def test_archive_is_incremental(spark, raw, tmp_path):
    root, put = raw
    clean, tables = str(tmp_path / "clean"), catalogue.survey_catalogue(spark)
    status = sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"])
    counts = {r.status: r["count"] for r in status.groupBy("status").count().collect()}
    assert counts["ok"] == 2 and set(counts) == {"ok", "missing"}
    assert [r.geography for r in spark.read.parquet(f"{clean}/_rejects").collect()] == ["Broken"]
    archive = sinks.read_archive(spark, clean)
    assert {(r.table_id, r["count"]) for r in archive.groupBy("table_id").count().collect()} == {("2.2.11", 8), ("2.2.1", 4)}
    assert dict(archive.dtypes)["table_id"] == "string"
    built = {r.table_id: r.built for r in sinks.built_files(spark, clean).groupBy("table_id").agg(F.max("built").alias("built")).collect()}

    put("Rms/2.2.1/Ottawa.csv")
    later = max(built.values()).timestamp() + 5
    os.utime(root / "Rms/2.2.1/Ottawa.csv", (later, later))
    status = sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"])
    assert {(r.table_id, r.status) for r in status.where("status <> 'missing'").collect()} == {("2.2.1", "ok"), ("2.2.11", "skipped")}
    again = {r.table_id: r.built for r in sinks.built_files(spark, clean).groupBy("table_id").agg(F.max("built").alias("built")).collect()}
    assert again["2.2.11"] == built["2.2.11"] and again["2.2.1"] != built["2.2.1"]
    archive = sinks.read_archive(spark, clean)
    assert {(r.table_id, r["count"]) for r in archive.groupBy("table_id").count().collect()} == {("2.2.11", 8), ("2.2.1", 8)}
    plan = archive.where("table_id = '2.2.1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_id" in plan


def test_a_rebuild_lists_no_other_table(spark, raw):
    found = sinks.tidy_tree(spark, str(raw[0]), catalogue.survey_catalogue(spark), surveys=["Rms"], folders=["Rms/2.2.1"])
    inputs = found.long.inputFiles() + found.rejects.inputFiles()
    assert inputs and all("/Rms/2.2.1/" in f for f in inputs)


def test_a_table_of_unreadable_files_keeps_its_rows(spark, raw, tmp_path):
    root, put = raw
    clean, tables = str(tmp_path / "clean"), catalogue.survey_catalogue(spark)
    sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"])
    for name in ("St._John's", "Guelph-Eramosa_(TP)"):
        put(f"Rms/2.2.11/{name}.csv", b"No data available\r\n")
        os.utime(root / f"Rms/2.2.11/{name}.csv", (4e9, 4e9))
    status = sinks.build_archive(spark, str(root), clean, tables, surveys=["Rms"])
    assert {(r.table_id, r.status) for r in status.where("status <> 'missing'").collect()} == {("2.2.1", "skipped"), ("2.2.11", "no data")}
    assert sinks.read_archive(spark, clean).where("table_id = '2.2.11'").count() == 8


def test_views_over_an_archive(spark, raw, tmp_path):
    clean = str(tmp_path / "clean")
    sinks.build_archive(spark, str(raw[0]), clean, catalogue.survey_catalogue(spark), surveys=["Rms"])
    sinks.register_archive(spark, clean, ["Rms"])
    assert spark.sql("SELECT count(*) AS n FROM rms WHERE table_id = '2.2.1'").first().n == 4


def test_workbooks_are_built_incrementally(spark, tmp_path):
    from tallymart.operators.matrix import Recipe, recipe_frame

    def row(file, i, *cells):
        return (file, "Sheet1", i, [*cells])

    grid = spark.createDataFrame([
        row("one", 0, "Depots"), row("one", 1, "Geography", "2014Q1", "2014Q2"), row("one", 2, "Harbour", "4", "[x]"),
        row("two", 0, "Depots"), row("two", 1, "nothing of use"),
    ], "file string, sheet string, row_idx long, cells array<string>")
    tables = spark.createDataFrame([(f, "Sheet1", "Freight", f"t-{f}", "Depots", "x") for f in ("one", "two")],
                                   "file string, first_sheet string, survey string, table_id string, title string, slug string").join(
        recipe_frame(spark, [Recipe("x", "period", header_marker="Geography")]), "slug")
    clean = str(tmp_path / "clean")
    status = {(r.table_id, r.status) for r in sinks.build_workbooks(spark, grid, tables, clean).collect()}
    assert status == {("t-one", "ok"), ("t-two", "error")}
    assert {(r.value, r.source) for r in sinks.read_archive(spark, clean).collect()} == {(4.0, "static"), (None, "static")}
    assert [(r.file, r.sheet) for r in spark.read.parquet(f"{clean}/_rejects").collect()] == [("two", "Sheet1")]
    old = spark.createDataFrame([("Freight", "t-one", datetime(2001, 1, 1)), ("Freight", "t-two", datetime(2001, 1, 1))], "survey string, table_id string, modified timestamp")
    again = {(r.table_id, r.status) for r in sinks.build_workbooks(spark, grid, tables, clean, inputs=old).collect()}
    assert again == {("t-one", "skipped"), ("t-two", "error")}


def test_stream_archive(spark, raw, tmp_path):
    root, put = raw
    clean, checkpoint, tables = str(tmp_path / "s"), str(tmp_path / "c"), catalogue.survey_catalogue(spark)
    stream_archive(spark, str(root), clean, tables, checkpoint, surveys=["Rms"]).awaitTermination()
    assert sinks.read_archive(spark, clean).count() == 12
    put("Rms/2.2.1/Ottawa.csv")
    stream_archive(spark, str(root), clean, tables, checkpoint, surveys=["Rms"]).awaitTermination()
    assert {(r.table_id, r["count"]) for r in sinks.read_archive(spark, clean).groupBy("table_id").count().collect()} == {("2.2.11", 8), ("2.2.1", 8)}


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("Rms", "1", "ok", 0.25), ("Rms", "1", "error", 1.0), ("Rms", "2", "ok", 0.75)]
    records = spark.createDataFrame(rows, "survey string, table_id string, outcome string, latency_s double").withColumn("ts", F.current_timestamp())
    sinks.append_log(records, path)
    sinks.append_log(records.limit(1), path)
    log = files.run_log(spark, path)
    assert log.count() == 4 and log.columns[0] == "ts"
    out = str(tmp_path / "summary")
    stream_latency(spark.readStream.schema(files.RUN_LOG_SCHEMA).json(path), out, str(tmp_path / "c")).awaitTermination()
    got = {r.outcome: (r.n, r.max_latency) for r in spark.read.parquet(out).collect()}
    assert got == {"ok": (3, 0.75), "error": (1, 1.0)}


def test_lookup_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "m.csv").write_text("UID,CODE,NAME\n59932,0110,A - B\n")
    assert tuple(files.lookup(spark, str(tmp_path / "m.csv")).first()) == ("59932", "0110", "A - B")


def test_page_catalogue(spark, tmp_path):
    entry = {"page_url": "https://x/t/slug-1/", "title": "T", "section": "rental-market", "discovery": "html",
             "assets": [{"url": "https://x/a.xlsx", "status": 200, "size_bytes": 5, "last_modified": "z"}, {"url": "b", "status": 404}]}
    bare = {"page_url": "https://x/t/slug-2", "title": None, "section": "else", "assets": []}
    (tmp_path / "c.json").write_text(json.dumps({"tables": [entry, bare]}, indent=2))
    got = [tuple(r) for r in catalogue.page_catalogue(files.page_catalogue_json(spark, str(tmp_path / "c.json"))).orderBy("table_id").collect()]
    assert got == [("slug-1", "Rental Market", "rental-market", "T", "https://x/t/slug-1/", "https://x/a.xlsx", 5, "z"),
                   ("slug-2", "else", "else", None, "https://x/t/slug-2", None, None, None)]


def test_features(spark, tmp_path):
    text = ('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"CSDUID": "1", "PRUID": "35", "DGUID": NaN, "N": null},'
            ' "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"CSDUID": "2", "PRUID": "24"}, "geometry": null}]}')
    (tmp_path / "b.geojson").write_text(text)
    rows = geojson.read_features(spark, str(tmp_path / "b.geojson"), "PRUID", "35").collect()
    assert len(rows) == 1 and rows[0].properties == {"CSDUID": "1", "PRUID": "35", "N": None}
    assert json.loads(rows[0].geometry) == {"type": "Point", "coordinates": [1, 2]}
    assert geojson.read_features(spark, str(tmp_path / "b.geojson")).count() == 2


def test_stamped_read(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(3).write.parquet(path)
    stamps = files.read_stamped(spark, [path]).select("updated_at").distinct().collect()
    assert all(isinstance(r.updated_at, datetime) for r in stamps)
    assert files.newest_modification(spark, path).first().source_parquet_newest == max(r.updated_at for r in stamps)


def test_written_mart(spark, tmp_path):
    from tests.test_mart import OBS, ROWS

    provinces = spark.createDataFrame([("Ontario",)], "name string")
    metros = spark.createDataFrame([("35535", "0110", "Toronto")], "metro_uid string, metro_code string, name string")
    members = spark.createDataFrame([("3523009", "Guelph/Eramosa", "TP", "0110")], "district_uid string, name string, type string, metro_code string")
    inventory, tables = catalogue.metric_inventory(spark), catalogue.survey_catalogue(spark)
    path = str(tmp_path / "mart")
    sinks.write_mart(
        spark, spark.createDataFrame(ROWS, OBS), path, metrics=catalogue.metric_dimension(inventory, tables, "Agency"),
        table_map=catalogue.table_metric_map(inventory, tables),
        directory=geo.place_directory(provinces, metros, members, province_id=F.lit("ON")), province=F.lit("Ontario"),
    )
    assert sorted(p.name for p in (tmp_path / "mart" / "projections").iterdir() if p.is_dir()) == ["table_name=average_rent_by_bedroom"]
    table = sinks.read_projection(spark, path, "average_rent_by_bedroom")
    assert table.count() == 4 and {"bedroom_type", "avg_rent_dollars"} <= set(table.columns)
    assert spark.read.parquet(f"{path}/metrics").count() == 14
    meta = spark.read.parquet(f"{path}/_meta").first()
    assert meta.n_observations == spark.read.parquet(f"{path}/rental_observations").count() and meta.n_cma == 1
    stored = spark.read.parquet(f"{path}/rental_observations").agg(F.count_if("is_suppressed").alias("n"), F.max("updated_at").alias("newest")).first()
    assert (meta.n_suppressed, meta.source_parquet_newest) == (stored.n, stored.newest)  # counted by the writing job, equal to a scan
    assert [p.name for p in tmp_path.iterdir()] == ["mart"]
    with pytest.raises(KeyError):
        sinks.read_projection(spark, path, "nope")


def test_rejects_from_a_tree(spark, raw):
    root, _ = raw
    described = files.raw_files(spark, str(root), ["Rms"]).withColumn("breakdown", F.lit(None).cast("string"))
    assert [r.geography for r in tidy.rejected_files(described, ["table_id", "geography"]).collect()] == ["Broken"]
    assert mart.projections()
