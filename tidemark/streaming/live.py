"""The live run loop: one ordered feed of updates into the tables, with reconnection, skipped bad updates, figures and shutdown.

A provider's feed is one ordered stream, so one receiver reads it; what it hands on is bounded by ``capacity``. Everything after that,
decoding included, is a DataFrame job over a batch.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..metrics import Metrics
from ..operators.normalize import normalize_updates
from ..plans.pipeline import Progress, Summary, commit, maintain, settle
from ..plans.tables import Tables
from ..schema import UPDATE
from ..sources.live import TRANSPORTS, Subscription
from .recovery import Backoff, LiveStatus, SourceError, Throttle, reconnect_loop

def decoded(lines: DataFrame, cluster: str) -> DataFrame:
    """Envelope rows with ``error`` of JSON updates (``ordinal``, ``value``; binary parts in base64); a line that is none gives one error row."""
    updates = lines.select("ordinal", F.from_json("value", UPDATE).alias("u")).select("ordinal", "u.*")
    return normalize_updates(updates, cluster)


def commit_updates(tables: Tables, lines: DataFrame, stream_name: str, source: str, cluster: str, metrics: Metrics, status: LiveStatus, clock: Callable[[], int], batch: int | None = None, batch_size: int = 500, writer: str | None = None) -> Summary:
    """Decode a batch of lines (``ordinal``, ``value``) and commit it: events, and bad updates as dead letters with their reason and text, in one entry."""
    rows = decoded(lines, cluster).persist()
    try:
        told = rows.groupBy("kind", F.col("error").isNotNull().alias("bad")).agg(F.count("*").alias("n"), F.max_by("slot", "ordinal").alias("slot"), F.max("ordinal").alias("at")).collect()
        for r in sorted((r for r in told if not r["bad"]), key=lambda r: r["at"]):
            metrics.observed("live", r["kind"], int(r["slot"]), r["n"])
            status.observed(int(r["slot"]), clock())
        dead = None
        if bad := sum(r["n"] for r in told if r["bad"]):
            metrics.add("decode_errors_total", bad)
            status.decode_errors_total += bad
            reasons = rows.where("error is not null").groupBy("ordinal").agg(F.min("error").alias("reason"))
            dead = lines.join(reasons, "ordinal").select(F.lit(stream_name).alias("stream_name"), F.lit(source).alias("source"), F.lit(None).cast("long").alias("line_number"), "reason", F.col("value").alias("line"), F.current_timestamp().alias("seen_at"))
        done = commit(tables, rows.where("error is null").drop("error"), stream_name, batch, True, batch_size, writer, dead)
        maintain(tables)
    finally:
        rows.unpersist()
    if done.events_seen:
        metrics.observe_latency("events", done.write_seconds_last)
        status.persisted(clock())
    return done


@dataclass
class LiveLoop:
    """Reads ``transport`` until it is stopped or fails for good.

    Each attempt subscribes from the contiguous frontier as it is then, or without a slot where there is none, which risks a gap.
    Rows that the tables hold already are left out there.
    """

    tables: Tables
    stream_name: str
    subscription: Subscription
    transport: str
    cluster: str = "mainnet-beta"
    batch_size: int = 500
    capacity: int = 10_000
    linger_ms: int = 1000
    backoff: Backoff = field(default_factory=Backoff)
    metrics: Metrics = field(default_factory=Metrics)
    status: LiveStatus = field(default_factory=LiveStatus)
    on_progress: Progress | None = None
    sleep: Callable[[int], None] | None = None
    clock: Callable[[], int] = lambda: int(time.time() * 1000)
    totals: Summary = field(default_factory=Summary)
    stopped: threading.Event = field(default_factory=threading.Event)
    throttle: Throttle = field(default_factory=Throttle)
    options: dict = field(default_factory=dict)  # for the transport, next to the request

    def stop(self) -> None:
        """End after the batch in hand; what was received is written first."""
        self.stopped.set()

    def run(self) -> Summary:
        self._tell()
        settle(self.tables, self.stream_name)  # what a run that died has left
        try:
            reconnect_loop(self._attempt, self.backoff, self.sleep or (lambda ms: self.stopped.wait(ms / 1000)), self.clock, self._reconnecting)
        finally:
            self._tell()
        return self.totals

    def from_slot(self) -> int | None:
        """The contiguous frontier; the cursor would hide what is missing below it."""
        return self.tables.state().cursors.get(self.stream_name, {}).get("contiguous")

    def _reconnecting(self, attempt: int, delay: int, error: SourceError) -> None:
        self.status.reconnecting(attempt, delay, self.from_slot(), error)
        self.metrics.add("reconnect_attempts_total")

    def _attempt(self, _: int) -> None:
        if self.stopped.is_set():
            return
        request = self.subscription.with_from_slot(self.from_slot()).request() | self.options
        held: queue.Queue = queue.Queue(self.capacity)
        over = threading.Event()

        def receive() -> None:
            error: SourceError | None = SourceError("stream_closed", "the provider ended the stream")
            try:
                for line in TRANSPORTS[self.transport](request, 0):
                    while not over.is_set():
                        try:
                            held.put(line, timeout=0.2)  # waits while the writer is behind
                            break
                        except queue.Full:
                            continue
                    if over.is_set():
                        return
            except SourceError as e:
                error = e
            except Exception as e:
                error = SourceError("receive", str(e))
            while not over.is_set():
                try:
                    held.put(error, timeout=0.2)
                    return
                except queue.Full:
                    continue

        threading.Thread(target=receive, daemon=True).start()
        self.status.running()
        try:
            for lines, error in self._batches(held):
                if lines:
                    self._write(lines, held.qsize())
                if error:
                    raise error
        finally:
            over.set()

    def _batches(self, held: queue.Queue) -> Iterator[tuple[list[str], SourceError | None]]:
        """Up to ``batch_size`` lines, or what came within ``linger_ms``; an error comes after the lines before it."""
        lines: list[str] = []
        until = self.clock() + self.linger_ms
        while True:
            try:
                item = held.get(timeout=0.05)
            except queue.Empty:
                item = None
            if isinstance(item, SourceError):
                yield lines, item
                return
            if item is not None:
                lines.append(item)
            if len(lines) >= self.batch_size or self.stopped.is_set() or self.clock() >= until:
                yield lines, None
                lines, until = [], self.clock() + self.linger_ms
                if self.stopped.is_set():
                    return

    def _write(self, lines: list[str], depth: int) -> None:
        frame = self.tables.spark.createDataFrame(list(enumerate(lines)), "ordinal long, value string")
        self.metrics.channel(self.stream_name, depth, self.capacity)
        done = commit_updates(self.tables, frame, self.stream_name, self.transport, self.cluster, self.metrics, self.status, self.clock, batch_size=self.batch_size)
        if done.events_seen:
            self.totals.add(done)
            self.metrics.progress(self.totals)
        self._tell(bool(done.events_seen))

    def _tell(self, always: bool = True) -> None:
        if self.on_progress and (always or self.throttle.ready(self.clock())):
            self.on_progress(self.totals)


def file_transport(request: dict, start: int) -> Iterator[str]:
    """Updates of a file named in the request by ``path`` (for tests and dry runs; a network client registers itself alike)."""
    with open(request["path"]) as lines:
        yield from (line for line in lines if line.strip())
