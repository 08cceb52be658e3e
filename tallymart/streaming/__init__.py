"""Stream drivers of two batch jobs: the incremental archive and the run-log summary."""

from tallymart.streaming.drivers import stream_archive, stream_latency

__all__ = ["stream_archive", "stream_latency"]
