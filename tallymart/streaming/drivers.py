"""File streams that process what has arrived since the last run, then stop.

The checkpoint remembers the files already seen, so no timestamps are compared.
Batches may be repeated after a failure; both sinks replace whole results, so a
repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymart.operators.analytics import latency_by_outcome
from tallymart.sources import files, sinks


def stream_archive(spark: SparkSession, raw_root: str, clean_root: str, catalogue: DataFrame, checkpoint: str, *,
                   surveys: list[str] | None = None) -> StreamingQuery:
    """Rebuild the tables that got new raw files.

    A table is rebuilt from all its files, because its folder is replaced as a whole; its
    rejects below ``_rejects`` are replaced alike, those of other tables stay.
    """
    arrived = (
        spark.readStream.format("binaryFile").schema(spark.read.format("binaryFile").load(raw_root).schema)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(raw_root)
    )
    touched = files.with_path_fields(arrived.select("path"), raw_root, surveys)

    def rebuild(batch: DataFrame, _: int) -> None:
        due = [(r.survey, r.table_id) for r in batch.select(*sinks.TABLE_KEYS).distinct().collect()]
        if due:
            found = sinks.tidy_tree(batch.sparkSession, raw_root, catalogue, surveys=surveys, folders=[f"{s}/{t}" for s, t in due])
            sinks.write_archive(found.long, clean_root)
            sinks.write_rejects(batch.sparkSession, found.rejects, f"{clean_root.rstrip('/')}/_rejects", due)

    return (
        touched.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_latency(log: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Attempts, mean and worst latency per outcome over all log records so far.

    State is one row per outcome; each batch replaces the stored summary.
    """
    summary = latency_by_outcome(log, F.col("latency_s").cast("decimal(18,3)"))

    def store(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    return (
        summary.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
