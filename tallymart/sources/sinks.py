"""Archive, mart and log sinks, and the incremental archive build."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallymart.operators import geo, mart, matrix, tidy
from tallymart.operators.quality import stale_tables
from tallymart.session import shared_folder
from tallymart.sources import files
from tallymart.sources import manifest as manifests

TABLE_KEYS = ["survey", "table_id"]
FILE_KEYS = [*TABLE_KEYS, "geography"]

# Files up to this size are parsed as one row each, larger ones line by line.
ROW_LANE_BYTES = 16 * 1024 * 1024


def write_archive(long: DataFrame, path: str) -> dict:
    """All tables in one job, a folder per survey and table; only written tables are replaced.

    Rows are spread by AQE's rebalancing: small tables share tasks, a table holding
    most rows is split over many files.  Returns what the writing job itself counted:
    ``rows`` and ``tables``, the (survey, table_id) that received rows (one entry per
    table, not per row), so that no second scan of the output is needed.
    """
    seen = Observation("archive")
    (
        long.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(*TABLE_KEYS)).alias("tables"))
        .hint("rebalance", *TABLE_KEYS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*TABLE_KEYS).parquet(path)
    )
    # A plan that Catalyst proves empty runs no collecting node, and leaves an empty row.
    got = seen.get if seen._jo.getRow().length() else {}
    return {"rows": got.get("rows", 0), "tables": {(t["survey"], t["table_id"]) for t in got.get("tables") or []}}


def write_rejects(spark: SparkSession, rejects: DataFrame, path: str, due: list[tuple[str, str]]) -> None:
    """Rejects in a folder per survey and table: those of the tables due are replaced, all others stay.

    The folders of the due tables are removed first, so a table that has no rejects any
    more loses its old ones; then this build's rejects are added.
    """
    system, _ = _file_system(spark, path)
    for survey, table_id in due:
        _, at = _file_system(spark, f"{path.rstrip('/')}/survey={survey}/table_id={table_id}")
        system.delete(at, True)
    rejects.write.mode("append").partitionBy(*TABLE_KEYS).parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejects of all tables; table ids stay text."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], "survey string, table_id string")
    return read_archive(spark, path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Table ids stay text (2.10 is not 2.1)."""
    schema = spark.read.parquet(path).drop(*TABLE_KEYS).schema
    full = schema.add("survey", "string").add("table_id", "string")
    return spark.read.schema(full).parquet(path)


def built_files(spark: SparkSession, path: str) -> DataFrame:
    """(survey, table_id, built) of an archive's files; no content is read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    )
    return listed.select(
        F.regexp_extract("path", r"/survey=([^/]+)/", 1).alias("survey"),
        F.regexp_extract("path", r"/table_id=([^/]+)/", 1).alias("table_id"),
        F.col("modificationTime").alias("built"),
    )


@dataclass(frozen=True)
class Tidied:
    """Observations of a raw tree and the files that hold no table, with why."""

    long: DataFrame
    rejects: DataFrame


def tidy_tree(spark: SparkSession, raw_root: str, catalogue: DataFrame, *, surveys: list[str] | None = None,
              folders: list[str] | None = None, row_lane_bytes: int = ROW_LANE_BYTES) -> Tidied:
    """A raw tree -> long observations; the size of a file picks its lane, never its result.

    Only ``folders`` (``survey/table_id``) are listed and read, if given.  Large files are
    found by the listing; their lines are stored once, since that lane scans them several times.
    """
    keys = ["path", *FILE_KEYS]
    breakdowns = catalogue.groupBy("table_id").agg(F.max("breakdown").alias("breakdown"))
    listed = files.raw_files(spark, raw_root, surveys, folders).join(breakdowns, "table_id", "left")
    small = listed.where(F.col("length") <= row_lane_bytes)
    long, rejects = tidy.tidy_files(small, keys), tidy.rejected_files(small, keys)
    large = listed.where(F.col("length") > row_lane_bytes).select(*keys, "breakdown")
    if not large.isEmpty():
        lines = files.with_path_fields(files.raw_lines(spark, raw_root, row_lane_bytes, folders), raw_root, surveys)
        path = shared_folder(spark, "lines")
        lines.write.parquet(path)
        lines = spark.read.parquet(path)
        long = long.unionByName(tidy.tidy_lines(lines, large, keys))
        rejects = rejects.unionByName(tidy.rejected_lines(lines, large, keys))
    return Tidied(long.drop("path"), rejects)


def build_archive(spark: SparkSession, raw_root: str, clean_root: str, catalogue: DataFrame, *,
                  surveys: list[str] | None = None, incremental: bool = True, manifest: str | None = None) -> DataFrame:
    """Rebuild the tables whose raw files are newer than their output (all, if not incremental).

    Files without a table are written below ``_rejects`` of the archive, in a folder per
    table, replaced only for the tables rebuilt; a table all of whose files are such keeps
    its former rows.  Returns (survey, table_id, status) of every table with raw files:
    ``ok``, ``skipped`` (up to date) or ``no data``, and of tables of the catalogue without
    any, ``missing``.

    With ``manifest`` (a folder of its own), the tree is compared with the stored manifest
    instead of being listed as a whole: only table folders whose time moved are listed, and a
    table is due when a file of it was added, changed or removed (see ``sources.manifest``).
    """
    if manifest is not None:
        diff = manifests.diff(spark, raw_root, manifest, surveys=surveys, full=not incremental, glob="*.csv")
        stored = manifests.files_of(spark, manifest)
        listed = files.with_path_fields(stored.select("path", "modified"), raw_root, surveys)
        known = listed.select(*TABLE_KEYS, "modified")
        moved = diff.changes.where(F.col("change") != "same") if incremental else diff.changes
        due = moved.select(*TABLE_KEYS).distinct()
    else:
        known = files.raw_files(spark, raw_root, surveys).select(*TABLE_KEYS, F.col("modificationTime").alias("modified"))
        known = _stored(spark, known, "listing")
        due = known.select(*TABLE_KEYS).distinct()
        if incremental and folder_exists(spark, clean_root):
            due = stale_tables(known, built_files(spark, clean_root), TABLE_KEYS).select(*TABLE_KEYS)
    # One entry per table folder: the driver names them to the scan, so no other folder is opened.
    due_keys = [(r.survey, r.table_id) for r in due.collect()]
    folders = [f"{s}/{t}" for s, t in due_keys]
    rejects_path = f"{clean_root.rstrip('/')}/_rejects"
    if folders:
        found = tidy_tree(spark, raw_root, catalogue, surveys=surveys, folders=folders)
        write_archive(found.long, clean_root)
        write_rejects(spark, found.rejects, rejects_path, due_keys)
    due = spark.createDataFrame(due_keys, "survey string, table_id string").withColumn("due", F.lit(True))
    bad = read_rejects(spark, rejects_path).groupBy(*TABLE_KEYS).agg(F.count("*").alias("n_bad"))
    counted = known.groupBy(*TABLE_KEYS).agg(F.count("*").alias("n_files")).join(due, TABLE_KEYS, "left").join(bad, TABLE_KEYS, "left")
    status = F.when(F.col("due").isNull(), "skipped").when(F.col("n_bad") == F.col("n_files"), "no data").otherwise("ok")
    seen = _stored(spark, counted.select(*TABLE_KEYS, status.alias("status")), "status")
    missing = catalogue.select(*TABLE_KEYS).distinct().join(seen, TABLE_KEYS, "left_anti")
    if surveys is not None:
        missing = missing.where(F.col("survey").isin(*surveys))
    return seen.unionByName(missing.withColumn("status", F.lit("missing")))


def build_workbooks(spark: SparkSession, grid: DataFrame, tables: DataFrame, clean_root: str, *, inputs: DataFrame | None = None) -> DataFrame:
    """The same for workbook grids: (survey, table_id, status), observations written below ``clean_root``.

    ``inputs`` is (survey, table_id, modified) of the workbooks; with it, tables whose output
    is newer are skipped.  Sheets without a header row go to ``_rejects`` (a folder per
    table, replaced for the tables built).  A status is that of this build, as the writing
    job counted it: ``ok`` if the table received rows, ``error`` if it was due and received
    none (its former rows, if any, stay), ``skipped`` if it was not due.
    """
    wanted = tables
    if inputs is not None and folder_exists(spark, clean_root):
        due = stale_tables(inputs, built_files(spark, clean_root), TABLE_KEYS).select(*TABLE_KEYS)
        wanted = tables.join(_stored(spark, due, "due"), TABLE_KEYS, "left_semi")
    wanted = _stored(spark, wanted, "workbooks")
    due_keys = [(r.survey, r.table_id) for r in wanted.select(*TABLE_KEYS).distinct().collect()]  # one row per table
    written = write_archive(matrix.matrix_long(grid, wanted), clean_root)["tables"] if due_keys else set()
    rejects = matrix.headerless_sheets(grid, wanted).join(wanted.select("file", *TABLE_KEYS), "file")
    write_rejects(spark, rejects, f"{clean_root.rstrip('/')}/_rejects", due_keys)
    built = spark.createDataFrame([(s, t, (s, t) in written) for s, t in due_keys], "survey string, table_id string, has_rows boolean")
    status = F.when(F.col("has_rows").isNull(), "skipped").when(~F.col("has_rows"), "error").otherwise("ok")
    return tables.select(*TABLE_KEYS).distinct().join(built, TABLE_KEYS, "left").select(*TABLE_KEYS, status.alias("status"))


def _stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def register_views(spark: SparkSession, root: str, names: Sequence[str], prefix: str = "") -> None:
    """Stored tables ``root/<name>`` as temporary views ``prefix + name``, to be queried in SQL."""
    for name in names:
        spark.read.parquet(f"{root.rstrip('/')}/{name}").createOrReplaceTempView(f"{prefix}{name}")


def register_archive(spark: SparkSession, clean_root: str, surveys: Sequence[str]) -> None:
    """A view per survey of an archive, under its lower-case name; a query scans only its survey's folders."""
    whole = read_archive(spark, clean_root)
    for survey in surveys:
        whole.where(F.col("survey") == survey).createOrReplaceTempView(survey.lower())


def write_mart(spark: SparkSession, observations: DataFrame, path: str, *, metrics: DataFrame, table_map: DataFrame,
               directory: DataFrame, province: Column, projections: bool = True, source_newest: DataFrame | None = None,
               revision: str = "", coverage: str = "%d metros, %d districts with data, %d districts without") -> None:
    """Publish the star at ``path``, in one step: a new folder is filled and then takes the place of the old one.

    The fact is written first and read back, so dimensions and projections scan the
    stored table instead of recomputing it.  All projections are one job, a folder
    per projection; an empty one gets no folder.  ``_meta`` records the build;
    ``source_newest`` is a one-row frame as of ``files.newest_modification``.
    """
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    fact_path = f"{new}/rental_observations"
    gates = Observation("fact")
    shaped = mart.shape_fact(mart.place_fact(observations, table_map, directory))
    shaped.observe(gates, *mart.fact_gates(), F.max("updated_at").alias("source_parquet_newest")).write.parquet(fact_path)
    fact = spark.read.parquet(fact_path)
    # the writing job counted the fact; _meta reads those figures instead of scanning it again
    seen = gates.get if gates._jo.getRow().length() else {}
    counted = spark.createDataFrame([(seen.get("n_observations", 0), seen.get("n_suppressed", 0))], "n_observations long, n_suppressed long")
    places = geo.geography_dimension(fact, directory, province=province)
    newest = source_newest if source_newest is not None else spark.createDataFrame([(seen.get("source_parquet_newest"),)], StructType([StructField("source_parquet_newest", shaped.schema["updated_at"].dataType)]))
    outputs = {
        "geographies": places,
        "metrics": metrics,
        "dimension_values": mart.dimension_values(fact),
        "_meta": mart.meta_row(counted, places, built_at=F.current_timestamp(), source_newest=newest, revision=revision, coverage=coverage),
    }
    writers = [partial(df.write.parquet, f"{new}/{name}") for name, df in outputs.items()]
    if projections:
        labelled = mart.all_projections(mart.star(fact, metrics, mart.unique_places(directory, province)))
        writer = labelled.hint("rebalance", "table_name").write
        writers.insert(0, partial(writer.partitionBy("table_name").parquet, f"{new}/projections"))
    # The outputs only share the stored fact, so their jobs run side by side.
    with ThreadPoolExecutor(len(writers)) as pool:
        for done in [pool.submit(write) for write in writers]:
            done.result()
    replace_folder(spark, new, path)


def read_projection(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One published projection under its own column names; only its folder is scanned."""
    spec = next((p for p in mart.projections() if p.name == name), None)
    if spec is None:
        raise KeyError(f"no projection {name!r}")
    rows = spark.read.parquet(f"{path}/projections").where(F.col("table_name") == name).drop("table_name")
    return rows.withColumnsRenamed({"category": spec.category_column, "value": spec.value_column})


def append_log(records: DataFrame, path: str) -> None:
    """One JSON line per attempt."""
    records.write.mode("append").json(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's view of the store that ``path`` lies in (reached through the classic session's JVM)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, at = _file_system(spark, path)
    system.delete(at, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Rename ``new`` to ``path``; what was there goes once the new folder is in its place."""
    system, at = _file_system(spark, path)
    _, source = _file_system(spark, new)
    _, old = _file_system(spark, f"{new}-old")
    if system.exists(at):
        system.rename(at, old)
    if not system.rename(source, at):
        raise OSError(f"{new} could not be moved to {path}")
    system.delete(old, True)
