"""The service's answers as plain values: health, readiness, status, metrics, and the consumer routes."""

from __future__ import annotations

from collections.abc import Callable

from .metrics import Metrics
from .plans import api
from .plans.pipeline import Summary
from .plans.tables import Tables
from .streaming.recovery import LiveStatus

SNAPSHOT_FIELDS = ("last_persisted_slot", "last_contiguous_finalized_slot", "last_finalized_slot", "events_seen", "events_skipped", "batches_written", "events_attempted", "events_inserted", "events_deduplicated")


class Service:
    """Each answer is (status code, body). A failing table query answers 500 and says no more than that."""

    def __init__(self, tables: Tables, stream_name: str, mode: str = "replay", metrics: Metrics | None = None, live: LiveStatus | None = None):
        self.tables, self.stream_name, self.mode, self.metrics, self.live = tables, stream_name, mode, metrics or Metrics(), live
        self.summary = Summary()

    def update(self, summary: Summary) -> None:
        self.summary = summary

    def health(self) -> tuple[int, str]:
        return 200, "ok"

    def ready(self) -> tuple[int, dict]:
        return 200, {"ready": True}

    def status(self, now_ms: int = 0) -> tuple[int, dict]:
        body = {"health": "ok", "mode": self.mode, "stream_name": self.stream_name} | {k: getattr(self.summary, k) for k in SNAPSHOT_FIELDS}
        if self.live is not None:
            body["live"] = self.live.snapshot(now_ms, self.summary.last_persisted_slot)
        return 200, body

    def render_metrics(self) -> tuple[int, str]:
        return 200, self.metrics.render()

    def _rows(self, query: Callable) -> tuple[int, object]:
        try:
            return 200, [r.asDict() for r in query().collect()]
        except Exception:
            return 500, {"error": "storage query failed"}

    def recent_events(self, event_type: str | None = None, limit: int | None = None) -> tuple[int, object]:
        return self._rows(lambda: self.tables.newest("events", lambda rows: api.recent_events(rows, event_type, limit), api.clamp(limit)))

    def recent_swaps(self, program_id: str | None = None, limit: int | None = None) -> tuple[int, object]:
        return self._rows(lambda: self.tables.newest("swaps", lambda rows: api.recent_swaps(rows, program_id, limit), api.clamp(limit)))

    def stream_lag(self, name: str) -> tuple[int, object]:
        code, rows = self._rows(lambda: api.stream_lag(self.tables.read("stream_cursors"), name))
        return (code, rows[0]) if code == 200 else (code, rows)
