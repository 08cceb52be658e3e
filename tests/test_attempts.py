"""The attempt log as a stream with keyed state and timers, against the batch rule."""

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from tallymart.streaming import attempts

DAY_MS = 86_400_000


def batch_rule(rows, delay_days, ttl_days):
    watermark = max(r[3] for r in rows) - timedelta(days=delay_days)
    out = {}
    for key in {(r[0], r[1]) for r in rows}:
        mine = [r for r in rows if (r[0], r[1]) == key]
        empties = [r[3] for r in mine if r[2] == "empty"]
        if any(r[2] == "ok" for r in mine):
            out[key] = "done"
        elif empties and max(empties) >= watermark - timedelta(days=ttl_days):
            out[key] = "empty"
        else:
            out[key] = "pending"
    return out


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    rng = random.Random(5)
    start = datetime(2020, 1, 1)
    rows = [(f"p{rng.randrange(40)}", f"t{rng.randrange(3)}", rng.choice(["ok", "empty", "empty", "empty", "error", "error", "error"]), start + timedelta(days=i // 3))
            for i in range(240)]
    # files arrive out of order, but never later than the delay (30 days) behind the newest record seen
    chunks = [rows[i : i + 20] for i in range(0, len(rows), 20)]
    order = sorted(range(len(chunks)), key=lambda i: i + rng.random() * 1.5)
    log = str(tmp_path / "log")
    for n, i in enumerate(order):
        part = chunks[i][:]
        rng.shuffle(part)
        spark.createDataFrame(part, attempts.LOG).coalesce(1).write.mode("append").parquet(log)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    attempts.stream_statuses(spark, log, out, cp, delay="30 days", ttl_ms=20 * DAY_MS, files_per_batch=1).awaitTermination()
    got = {(r.place, r.table_id): r.status for r in attempts.latest_statuses(spark, out).collect()}
    want = batch_rule(rows, 30, 20)
    assert got == want
    assert {"done", "empty", "pending"} <= set(want.values())
    # expired markers were turned back to pending by a timer, not left as they were
    assert spark.read.parquet(out).where("status = 'empty'").join(attempts.latest_statuses(spark, out).where("status = 'pending'"), attempts.KEYS).count() > 0


def test_stream_of_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.createDataFrame([], attempts.LOG).write.parquet(log)
    out = str(tmp_path / "out")
    attempts.stream_statuses(spark, log, out, str(tmp_path / "cp"), delay="1 day", ttl_ms=DAY_MS).awaitTermination()
    import os
    assert not os.path.exists(out) or spark.read.parquet(out).count() == 0


class HeldState:
    """A GroupState outside of a stream."""

    def __init__(self):
        self.exists, self.hasTimedOut, self.watermark, self.timeout, self.get = False, False, 0, None, None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, at):
        assert at >= self.watermark
        self.timeout = at


def test_one_call_folds_many_keys_and_tells_each_end_once():
    fold, state = attempts.keep_state(10 * DAY_MS), HeldState()
    day = lambda n: pd.Timestamp(n * DAY_MS, unit="ms")
    batch = pd.DataFrame([("a", "ok", day(1)), ("b", "empty", day(2)), ("c", "empty", day(5)), ("d", "error", day(5)), (None, "empty", day(3))],
                         columns=["table_id", "outcome", "tried_at"])
    run = lambda batches: {None if pd.isna(r.table_id) else r.table_id: r.status for out in fold(("p", 0), iter(batches), state) for r in out.itertuples()}
    assert run([batch]) == {"a": "done", "b": "empty", "c": "empty", "d": "pending", None: "empty"} and state.timeout == 12 * DAY_MS
    state.hasTimedOut, state.watermark = True, 12 * DAY_MS + 1
    assert run([]) == {"b": "pending"} and state.timeout == 13 * DAY_MS
    state.hasTimedOut, state.watermark = False, 14 * DAY_MS
    assert run([pd.DataFrame([("b", "empty", day(6))], columns=batch.columns)]) == {"b": "empty", None: "pending"} and state.timeout == 15 * DAY_MS
    state.hasTimedOut, state.watermark = True, 17 * DAY_MS
    assert run([]) == {"b": "pending", "c": "pending"}
