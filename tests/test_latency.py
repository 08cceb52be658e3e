"""Latency quantiles from day sketches: exact counts, ranks within the sketch's error, re-runs counted once."""

import duckdb
import numpy as np

from tallymart.plans.archive import latency_quantiles

SF = "/root/testdata/sf0.01"


def test_quantiles_within_rank_error(spark):
    got = {r.outcome: r for r in latency_quantiles(spark, SF).collect()}
    rows = duckdb.sql(f"SELECT event_type, value FROM '{SF}/events.parquet' WHERE value IS NOT NULL AND ts IS NOT NULL").fetchall()
    assert set(got) == {o for o, _ in rows}
    for outcome, r in got.items():
        values = np.sort([v for o, v in rows if o == outcome])
        assert r.n == len(values)  # the re-run days count once
        for q, v in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
            rank = np.searchsorted(values, v, "right") / len(values)
            assert abs(rank - q) <= 0.03, (outcome, q, rank)
