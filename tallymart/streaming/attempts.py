"""Attempts of (table, place) requests as a stream with keyed state and timers.

Each key (place, table_id) has a small state: whether an attempt succeeded (``done``, for
good) and the time of its latest empty answer (``empty_at``).  An empty answer counts as a
marker only while it is young: a timer on event time fires when the watermark passes
``empty_at + ttl``, and the key is pending again.  Records later than the watermark's delay
are dropped by Spark before they reach the state; within the delay the arrival order does
not matter, since the state keeps only a flag and a maximum.

The states of a place's keys are dealt by a hash of the table into SHARES, and those of a
share are held together, sorted by table_id, with one timer for the first of their markers to
end.  So Python is called once for many keys and folds them by array operations, and no place
gathers in one task.

Every change of a key's status is emitted with its batch; the latest per key is the status.
Over the same log this equals the batch rule of ``operators.jobs.pending_jobs``: a key is
done if any attempt was ``ok``, known empty if its latest empty answer is no older than the
final watermark less ``ttl``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEYS = ["place", "table_id"]
LOG = "place string, table_id string, outcome string, tried_at timestamp"
STATUS = "place string, table_id string, status string, empty_at timestamp"
#: Per share of a place: its tables (sorted), and for each done, the latest empty answer (microseconds) and whether its end was told.
STATE = "tables array<string>, done array<boolean>, empty_at array<long>, ended array<boolean>"
#: Shares that the tables of a place are dealt into.
SHARES = 2
#: Stands for no empty answer.
_NEVER = -(1 << 62)


def keep_state(ttl_ms: int):
    """The function of ``applyInPandasWithState``: fold new attempts into the keys' states, or expire their markers."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        parts = []
        if state.exists:
            tables, done, empty_at, ended = state.get
            parts.append(pd.DataFrame({
                "table_id": pd.Series(tables, dtype=object), "done": np.array(done, bool), "empty_at": np.array(empty_at, np.int64),
                "told": np.array(ended, bool), "new": False,
            }))
        if not state.hasTimedOut:
            for batch in batches:
                at = batch["tried_at"].astype("datetime64[us]").astype("int64")
                parts.append(pd.DataFrame({
                    "table_id": batch["table_id"].astype(object), "done": batch["outcome"] == "ok",
                    "empty_at": at.where((batch["outcome"] == "empty") & batch["tried_at"].notna(), _NEVER), "told": False, "new": True,
                }))
        after = pd.concat(parts).groupby("table_id", dropna=False).max().reset_index()
        tables, done, empty_at = after["table_id"], after["done"].to_numpy(bool), after["empty_at"].to_numpy(np.int64)
        ends = empty_at // 1000 + ttl_ms
        marked = ~done & (empty_at != _NEVER)
        ended = marked & (ends < watermark)
        state.update(([None if pd.isna(t) else t for t in tables], done.tolist(), empty_at.tolist(), ended.tolist()))
        if (marked & ~ended).any():
            state.setTimeoutTimestamp(int(ends[marked & ~ended].min()))
        changed = after["new"].to_numpy(bool) | (ended & ~after["told"].to_numpy(bool))
        at = empty_at[changed].astype("datetime64[us]")
        at[empty_at[changed] == _NEVER] = np.datetime64("NaT")
        yield pd.DataFrame({
            "place": key[0], "table_id": tables[changed].to_numpy(),
            "status": np.where(done, "done", np.where(marked & ~ended, "empty", "pending"))[changed],
            "empty_at": pd.Series(at).astype("datetime64[ns]"),
        })

    return fold


def stream_statuses(spark: SparkSession, log_path: str, out_path: str, checkpoint: str, *, delay: str, ttl_ms: int,
                    files_per_batch: int | None = None) -> StreamingQuery:
    """Read the attempt log as it grows, keep each key's state, and append every change of status.

    ``out_path`` receives (place, table_id, status, empty_at, batch); ``latest_statuses``
    reads the status of each key from it.  The run stops when the log is read.
    """
    reader = spark.readStream.schema(LOG)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    attempts = reader.parquet(log_path).withWatermark("tried_at", delay)
    share = F.pmod(F.xxhash64("table_id"), F.lit(SHARES)).cast("int")
    changes = attempts.withColumn("share", share).groupBy("place", "share").applyInPandasWithState(
        keep_state(ttl_ms), STATUS, STATE, "update", GroupStateTimeout.EventTimeTimeout)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out_path)

    return changes.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_statuses(spark: SparkSession, out_path: str) -> DataFrame:
    """The last status of every key: one row per key, by its latest batch."""
    changes = spark.read.schema(STATUS + ", batch long").parquet(out_path)
    last = F.max_by(F.struct("status", "empty_at"), "batch").alias("last")
    return changes.groupBy(*KEYS).agg(last).select(*KEYS, "last.*")
