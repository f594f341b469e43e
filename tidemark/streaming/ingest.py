"""Streaming ingestion: foreachBatch commits, idempotent by the query's id and batch id."""

from __future__ import annotations

import time
from concurrent.futures import Future
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..metrics import Metrics
from ..plans.pipeline import BATCH_SIZE, Progress, Summary, commit, maintain
from ..plans.tables import Tables
from .feed import Watch
from .live import commit_updates
from .recovery import LiveStatus


@dataclass
class Ingest:
    """A sink for envelope rows (with ``ordinal``), or for lines of updates (``value``) where a ``cluster`` is named.

    ``on_progress`` is called once before, after each batch and at the end. With ``metrics``, a listener sets the figures of the running query.
    """

    tables: Tables
    stream_name: str
    advance_frontier: bool = True
    on_progress: Progress | None = None
    metrics: Metrics | None = None
    batch_size: int = BATCH_SIZE
    totals: Summary = field(default_factory=Summary)
    query: Future = field(default_factory=Future)
    cluster: str | None = None
    status: LiveStatus = field(default_factory=LiveStatus)
    watch: Watch | None = None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        # The query's id lives in its checkpoint, so a batch is known again after a restart and never taken for another query's.
        writer = f"query:{self.query.result()}"
        if self.cluster is not None:
            done = self._updates(rows, batch_id, writer)
        else:
            done = commit(self.tables, rows, self.stream_name, batch_id, self.advance_frontier, self.batch_size, writer=writer)
            if self.metrics and done.events_seen:
                self.metrics.observe_latency("events", done.write_seconds_last)
        if not done.events_seen:
            return
        self.totals.add(done)
        if self.metrics:
            self.metrics.progress(self.totals)
        if self.on_progress:
            self.on_progress(self.totals)
        maintain(self.tables)

    def _updates(self, rows: DataFrame, batch_id: int, writer: str) -> Summary:
        lines = rows.where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("ordinal"), "value").persist()
        try:
            return commit_updates(self.tables, lines, self.stream_name, "files", self.cluster, self.metrics or Metrics(), self.status, lambda: int(time.time() * 1000), batch_id, self.batch_size, writer)
        finally:
            lines.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True, interval: str = "1 second") -> StreamingQuery:
        if self.on_progress:
            self.on_progress(self.totals)
        self.query = Future()
        if self.metrics and not self.watch:
            self.watch = Watch(self.stream_name, self.metrics, self.status)
            self.tables.spark.streams.addListener(self.watch)
        writer = stream.writeStream.queryName(self.stream_name).foreachBatch(self.write).option("checkpointLocation", checkpoint)
        started = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
        self.query.set_result(started.id)
        return started

    def close(self) -> None:
        if self.watch:
            self.tables.spark.streams.removeListener(self.watch)
            self.watch = None

    def run(self, stream: DataFrame, checkpoint: str) -> Summary:
        """Process what there is, then return the totals. A source error surfaces after the batches before it are committed."""
        try:
            self.start(stream, checkpoint).awaitTermination()
        finally:
            self.close()
        if self.on_progress:
            self.on_progress(self.totals)
        return self.totals
