"""Raw files, lines, lookups and stamped parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.functions import file_name_to_place
from tallymart.functions.text import LINE_BREAK

PAGE_CATALOGUE_SCHEMA = (
    "tables array<struct<page_url: string, title: string, section: string, discovery: string, "
    "assets: array<struct<url: string, status: string, size_bytes: bigint, last_modified: string>>>>"
)
RUN_LOG_SCHEMA = (
    "ts timestamp, survey string, table_id string, geography string, outcome string, "
    "latency_s double, error_class string, error_msg string"
)


def with_path_fields(df: DataFrame, root: str, surveys: Sequence[str] | None = None) -> DataFrame:
    """survey, table_id and geography of ``<root>/<survey>/<table_id>/<place>.csv`` paths.

    Paths at any other depth are left out, and so are folders that are no survey.
    """
    pattern = rf"{re.escape(root.rstrip('/'))}/([^/]+)/([^/]+)/([^/]+)\.csv$"

    def part(group: int) -> Column:
        return F.regexp_extract("path", pattern, group)

    found = df.where(F.col("path").rlike(pattern)).select(
        part(1).alias("survey"), part(2).alias("table_id"), file_name_to_place(part(3)).alias("geography"),
        *df.columns,
    )
    return found if surveys is None else found.where(F.col("survey").isin(*surveys))


def raw_files(spark: SparkSession, root: str, surveys: Sequence[str] | None = None, folders: Sequence[str] | None = None) -> DataFrame:
    """Every table file below ``root``: path fields, modificationTime, length, content.

    Content is only read when a query asks for it.  With ``folders`` (``survey/table_id``)
    nothing else is listed; Spark lists many folders as a job.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(_places(root, folders))
    )
    return with_path_fields(listed, root, surveys)


def _places(root: str, folders: Sequence[str] | None) -> str | list[str]:
    return root if folders is None else [f"{root.rstrip('/')}/{f}" for f in folders]


def raw_lines(spark: SparkSession, root: str, larger_than: int = -1, folders: Sequence[str] | None = None) -> DataFrame:
    """(path, pos, line) of the table files above a size, with gapless positions.

    The size test prunes files at planning time.  Files are read in splits; a line's
    position is its place in the split plus the lines of the file's earlier splits,
    for which only one number per split is summed up.
    """
    meta = F.col("_metadata")
    decoded_path = F.try_url_decode(F.replace(meta["file_path"], F.lit("+"), F.lit("%2B")))
    text = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(_places(root, folders))
        .where(meta["file_size"] > larger_than)
        .select(
            decoded_path.alias("path"), meta["file_block_start"].alias("block"),
            # The text source keeps raw bytes; they are latin-1.
            F.explode(F.split(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), LINE_BREAK)).alias("line"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    blocks = text.groupBy("path", "block").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return text.join(offsets, ["path", "block"]).select(
        "path", (F.col("offset") + F.col("id") - F.col("first_id")).alias("pos"), "line"
    )


def lookup(spark: SparkSession, path: str) -> DataFrame:
    """Reference CSV with a header; every column stays text so that ids keep leading zeros."""
    return spark.read.option("header", "true").csv(path)


def read_stamped(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet rows with the modification time of their file as ``updated_at``."""
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_modification_time").alias("updated_at"))


def newest_modification(spark: SparkSession, root: str) -> DataFrame:
    """One row: the newest modification time of any parquet file below ``root``."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    )
    return listed.agg(F.max("modificationTime").alias("source_parquet_newest"))


def page_catalogue_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_CATALOGUE_SCHEMA).option("multiLine", "true").json(path)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(path)
