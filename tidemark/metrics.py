"""Metrics in Prometheus text form, and the same figures as DataFrame aggregates."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from .plans.pipeline import Summary

#: Bounds of the latency histogram in seconds.
LATENCY_BOUNDS = tuple(0.001 * 2**k for k in range(15))
#: name, type, labels, help.
FAMILIES = (
    ("batch_write_latency_seconds", "histogram", ("writer",), "How long the write of a batch took."),
    ("channel_depth", "gauge", ("stream_name",), "Events waiting to be written."),
    ("channel_capacity", "gauge", ("stream_name",), "Events that may wait."),
    ("channel_utilization_ratio", "gauge", ("stream_name",), "Share of the capacity in use."),
    ("ingest_events_total", "counter", ("source", "event_type"), "Events received by source and type."),
    ("last_observed_slot", "gauge", (), "Slot of the last event seen."),
    ("last_finalized_slot", "gauge", (), "Last finalized slot."),
    ("last_persisted_slot", "gauge", (), "Last persisted slot."),
    ("slot_lag", "gauge", (), "Observed less persisted slot."),
    ("reconnect_attempts_total", "counter", (), "Reconnection attempts."),
    ("decode_errors_total", "counter", (), "Malformed updates skipped."),
    ("source_backlog_files", "gauge", ("stream_name",), "Files of a running query's source that wait."),
    ("source_backlog_bytes", "gauge", ("stream_name",), "Bytes of a running query's source that wait."),
    ("source_rows_per_second", "gauge", ("stream_name", "side"), "Rows that arrived and rows that were processed in a running query."),
)


def _escape(value: str) -> str:
    return value.replace("\\", "\\\\").replace("\n", "\\n").replace('"', '\\"')


class Histogram:
    """Counts by bound, with total, largest and last; its size does not grow with what it has seen."""

    def __init__(self) -> None:
        self.counts = [0] * len(LATENCY_BOUNDS)
        self.n, self.total, self.largest, self.last = 0, 0.0, 0.0, 0.0

    def add(self, value: float) -> None:
        for i, bound in enumerate(LATENCY_BOUNDS):
            self.counts[i] += value <= bound
        self.n, self.total, self.largest, self.last = self.n + 1, self.total + value, max(self.largest, value), value


class Metrics:
    def __init__(self, prefix: str = "tidemark_"):
        self.prefix = prefix
        self.values: dict[str, dict[tuple[str, ...], float]] = {name: ({(): 0.0} if not labels else {}) for name, kind, labels, _ in FAMILIES if kind != "histogram"}
        self.latency: dict[tuple[str, ...], Histogram] = {}

    def observe_latency(self, writer: str, seconds: float) -> None:
        self.latency.setdefault((writer,), Histogram()).add(seconds)

    def set(self, name: str, value: float, *labels: str) -> None:
        self.values[name][labels] = float(value)

    def add(self, name: str, value: float = 1, *labels: str) -> None:
        self.values[name][labels] = self.values[name].get(labels, 0.0) + value

    def channel(self, stream: str, depth: int, capacity: int) -> None:
        self.set("channel_depth", depth, stream)
        self.set("channel_capacity", capacity, stream)
        self.set("channel_utilization_ratio", depth / capacity if capacity else 0.0, stream)

    def progress(self, summary: Summary) -> None:
        """Markers of the tables, as of a finished batch."""
        if summary.last_persisted_slot is not None:
            self.slots(int(self.values["last_observed_slot"].get((), 0)) or summary.last_persisted_slot, summary.last_persisted_slot)
        if summary.last_finalized_slot is not None:
            self.set("last_finalized_slot", summary.last_finalized_slot)

    def observed(self, source: str, kind: str, slot: int, n: int = 1) -> None:
        """Events as they come in, before any is left out."""
        self.add("ingest_events_total", n, source, kind)
        self.slots(slot, int(self.values["last_persisted_slot"][()]))

    def slots(self, observed: int, persisted: int) -> None:
        self.set("last_observed_slot", observed)
        self.set("last_persisted_slot", persisted)
        self.set("slot_lag", max(0, observed - persisted))

    def render(self) -> str:
        out = []
        number = lambda v: str(int(v)) if float(v).is_integer() else repr(float(v))
        text = lambda names, values, more="": "{" + ",".join([f'{n}="{_escape(v)}"' for n, v in zip(names, values, strict=True)] + [more] * bool(more)) + "}" if names or more else ""
        for name, kind, labels, told in FAMILIES:
            full = self.prefix + name
            series = self.latency if kind == "histogram" else self.values[name]
            if not series:
                continue
            out += [f"# HELP {full} {told}", f"# TYPE {full} {kind}"]
            for key, value in sorted(series.items()):
                if kind == "histogram":
                    out += [f"{full}_bucket{text(labels, key, f'le="{number(b)}"')} {n}" for b, n in zip(LATENCY_BOUNDS, value.counts, strict=True)]
                    out += [f"{full}_bucket{text(labels, key, 'le="+Inf"')} {value.n}", f"{full}_sum{text(labels, key)} {number(value.total)}", f"{full}_count{text(labels, key)} {value.n}"]
                else:
                    out.append(f"{full}{text(labels, key)} {number(value)}")
        return "\n".join(out) + "\n"


def latency_histogram(df: DataFrame, seconds: str) -> DataFrame:
    """le, n: cumulative counts by bound, in one pass."""
    counts = df.agg(*[F.count_if(F.col(seconds) <= b).alias(f"b{i}") for i, b in enumerate(LATENCY_BOUNDS)])
    bounds = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(LATENCY_BOUNDS)])
    return counts.select(F.explode(bounds).alias("r")).select("r.*")


def ingest_counts(events: DataFrame, source: str) -> DataFrame:
    return events.groupBy(F.lit(source).alias("source"), "event_type").agg(F.count("*").alias("n"))
