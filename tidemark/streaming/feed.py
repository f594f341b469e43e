"""Updates that arrive as files in a folder, read by executors, and the figures of the running query.

A receiving process drops files of JSON lines into a folder that driver and executors share. Spark's file source names in its offset log which files a
batch reads, so the driver holds names only, a restart reads the same files again, and ``max_bytes`` limits what a batch takes on:
what comes faster waits as files.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from ..metrics import Metrics
from .recovery import LiveStatus


def updates(spark: SparkSession, path: str, max_bytes: int = 256 << 20) -> DataFrame:
    """A stream of ``value``, one JSON update a line."""
    return spark.readStream.option("lineSep", "\n").option("maxBytesPerTrigger", str(max_bytes)).text(path)


class Watch(StreamingQueryListener):
    """Puts the progress of one query, by its name, into metrics and status: backlog (where its source reports one), rates, latency, activity, and how it ended."""

    def __init__(self, name: str, metrics: Metrics, status: LiveStatus | None = None):
        self.name, self.metrics, self.status, self.ids = name, metrics, status or LiveStatus(), set()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:  # noqa: N802
        if event.name == self.name:
            self.ids.add(str(event.runId))
            self.status.running()

    def onQueryProgress(self, event: QueryProgressEvent) -> None:  # noqa: N802
        p = event.progress
        if p.name != self.name:
            return
        waiting = {k: sum(int(s.metrics.get(k, 0)) for s in p.sources) for k in ("numFilesOutstanding", "numBytesOutstanding")}
        self.metrics.set("source_backlog_files", waiting["numFilesOutstanding"], self.name)
        self.metrics.set("source_backlog_bytes", waiting["numBytesOutstanding"], self.name)
        rates = {k: sum(getattr(s, k) or 0 for s in p.sources) for k in ("inputRowsPerSecond", "processedRowsPerSecond")}
        self.metrics.set("source_rows_per_second", _finite(rates["inputRowsPerSecond"]), self.name, "arrived")
        self.metrics.set("source_rows_per_second", _finite(rates["processedRowsPerSecond"]), self.name, "processed")
        if p.numInputRows:
            self.metrics.observe_latency("trigger", p.durationMs.get("triggerExecution", 0) / 1000)
            self.status.last_event_at_unix_ms = int(time.time() * 1000)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:  # noqa: N802
        if str(event.runId) in self.ids:
            self.status.producer_state = "failed" if event.exception else "stopped"
            if event.exception:
                self.status.last_error_kind, self.status.last_error = "pipeline", event.exception.splitlines()[0]


def _finite(x: float) -> float:
    return x if x == x and abs(x) != float("inf") else 0.0
