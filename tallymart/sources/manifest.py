"""A stored manifest of a raw tree's files, kept per table folder, and what changed since the last run.

A raw tree is ``<root>/<survey>/<table_id>/<file>``.  The manifest holds one row per file
(survey, table_id, path, size, modified, run), partitioned by table folder, and one row per
table folder with the folder's own modification time.  A run lists the table folders only
(two directory levels: their number is that of tables, not of files), and lists the files of
those folders alone whose time differs from the manifest's, or that are new; Spark lists many
named folders as a job.  Their listing meets the stored rows of the same folders in a full
outer join on the path: a file is ``added``, ``removed``, ``changed`` (size or time differ) or
``same``.  Folders that are gone have all their files ``removed`` without any listing.  Only
the partitions of touched folders are written again.

A folder's time moves when a file in it is added, removed or renamed into place, which is how
files are written to stores that have folders; a file rewritten in place under its old name is
seen by a ``full`` run, which lists every folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "survey string, table_id string, path string, size bigint, modified timestamp, run string"
FOLDERS = "survey string, table_id string, folder_modified bigint, run string"
KEYS = ["survey", "table_id"]


@dataclass(frozen=True)
class Diff:
    """Files of touched folders with their change, and the folders whose files were listed."""

    changes: DataFrame
    listed: list[tuple[str, str]]
    run: str


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def table_folders(spark: SparkSession, root: str, surveys: Sequence[str] | None = None) -> list[tuple[str, str, str, int]]:
    """(survey, table_id, folder, modified in ms) of every table folder; files are not listed."""
    system, at = _system(spark, root)
    if not system.exists(at):
        return []
    found = []
    for survey in system.listStatus(at):
        name = survey.getPath().getName()
        if not survey.isDirectory() or name.startswith(("_", ".")) or (surveys is not None and name not in surveys):
            continue
        for table in system.listStatus(survey.getPath()):
            if table.isDirectory() and not table.getPath().getName().startswith(("_", ".")):
                found.append((name, table.getPath().getName(), table.getPath().toString(), int(table.getModificationTime())))
    return found


def _list_files(spark: SparkSession, folders: list[tuple[str, str, str]], glob: str) -> DataFrame:
    """survey, table_id, path, size, modified of the files in the named folders; no content is read."""
    if not folders:
        return spark.createDataFrame([], FILES).drop("run")
    by_path = spark.createDataFrame([(s, t, f.rstrip("/")) for s, t, f in folders], "survey string, table_id string, folder string")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load([f for _, _, f in folders])
    # a file's table folder is the part of its path above its own name
    folder = F.regexp_extract("path", r"^(.*)/[^/]+/?$", 1)
    files = listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), folder.alias("folder"))
    return files.join(by_path, "folder").select("survey", "table_id", "path", "size", "modified")


def diff(spark: SparkSession, root: str, manifest: str, *, surveys: Sequence[str] | None = None, full: bool = False,
         glob: str = "*", run: str | None = None) -> Diff:
    """Compare the tree with the manifest at ``manifest`` and store the new manifest there.

    Returns every file of every touched folder with ``change``; files of untouched folders
    are not part of it.  The first run finds every file ``added``.  Nothing of the manifest
    is read or written for folders outside ``surveys``.
    """
    run = run or uuid.uuid4().hex
    now = table_folders(spark, root, surveys)
    system, at = _system(spark, manifest)
    have = system.exists(_system(spark, f"{manifest}/folders")[1])
    before = {}
    if have:
        old = spark.read.schema(FOLDERS).parquet(f"{manifest}/folders")
        if surveys is not None:
            old = old.where(F.col("survey").isin(*surveys))
        before = {(r.survey, r.table_id): r.folder_modified for r in old.collect()}  # one row per table folder
    touched = [(s, t, f) for s, t, f, m in now if full or before.get((s, t)) != m]
    gone = sorted(set(before) - {(s, t) for s, t, _, _ in now})
    fresh = _list_files(spark, touched, glob).withColumn("run", F.lit(run))
    keys = touched + [(s, t, "") for s, t in gone]
    if have and keys:
        wanted = spark.createDataFrame([(s, t) for s, t, _ in keys], "survey string, table_id string")
        stored = spark.read.schema(FILES).parquet(f"{manifest}/files").join(wanted, KEYS, "left_semi")
    else:
        stored = spark.createDataFrame([], FILES)
    new, old = fresh.alias("new"), stored.alias("old")
    joined = new.join(old, F.col("new.path") == F.col("old.path"), "full_outer")
    change = (
        F.when(F.col("old.path").isNull(), "added")
        .when(F.col("new.path").isNull(), "removed")
        .when((F.col("new.size") != F.col("old.size")) | (F.col("new.modified") != F.col("old.modified")), "changed")
        .otherwise("same")
    )
    changes = joined.select(
        *(F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in ("survey", "table_id", "path", "size", "modified")),
        change.alias("change"),
        F.when(change == "same", F.col("old.run")).otherwise(F.lit(run)).alias("run"),
    )
    changes = _store(spark, changes, f"{manifest}/_runs/{run}")
    if keys:
        kept = changes.where(F.col("change") != "removed").select("survey", "table_id", "path", "size", "modified", "run")
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(f"{manifest}/files")
        for s, t in gone:
            system.delete(_system(spark, f"{manifest}/files/survey={s}/table_id={t}")[1], True)
    rows = [(s, t, m, run) for s, t, _, m in now]
    if have and surveys is not None:  # folders of other surveys stay as stored
        rows += [(r.survey, r.table_id, r.folder_modified, r.run) for r in spark.read.schema(FOLDERS).parquet(f"{manifest}/folders").where(~F.col("survey").isin(*surveys)).collect()]
    _replace(spark, spark.createDataFrame(rows, FOLDERS), f"{manifest}/folders")
    return Diff(changes, [(s, t) for s, t, _ in touched], run)


def files_of(spark: SparkSession, manifest: str) -> DataFrame:
    """The stored manifest: every file of the tree as of the last run."""
    return spark.read.schema(FILES).parquet(f"{manifest}/files")


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _replace(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write beside ``path``, then move into its place."""
    system, at = _system(spark, path)
    side = f"{path}-{uuid.uuid4().hex}"
    df.write.parquet(side)
    system.delete(at, True)
    if not system.rename(_system(spark, side)[1], at):
        raise OSError(f"{side} could not be moved to {path}")
