"""What an application may put in place of the Parquet tables and sources: the interfaces of the engine's ends."""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import dedup, slots
from .plans import pipeline
from .plans.commits import Clash
from .plans.tables import Tables, overlaps
from .sources.replay import read_jsonl


class EventSource(ABC):
    """Where events come from."""

    @abstractmethod
    def read_events(self) -> DataFrame:
        """Envelope rows with ``ordinal``, which grows in arrival order."""


class EventWriter(ABC):
    @abstractmethod
    def write(self, rows: DataFrame, batch: int) -> int:
        """Store event rows, the first of each id only; how many were new. The same batch again changes nothing."""


class CursorStore(ABC):
    @abstractmethod
    def load(self, stream_name: str) -> int | None:
        """Largest slot stored for a stream."""

    @abstractmethod
    def save(self, stream_name: str, slot: int) -> None:
        """Raise a stream's cursor; it never goes back."""


class SlotStore(ABC):
    @abstractmethod
    def save(self, states: DataFrame, stream_name: str, batch: int) -> None:
        """Merge slot states (slot, parent_slot, finalized, dead) into those of the stream."""

    @abstractmethod
    def advance(self, stream_name: str) -> tuple[int | None, int | None]:
        """The contiguous frontier and the finalized head after walking on."""


class SwapWriter(ABC):
    @abstractmethod
    def write(self, swaps: DataFrame, batch: int) -> int:
        """Append swaps as they are; how many."""


class JsonlSource(EventSource):
    def __init__(self, spark: SparkSession, path: str, mode: str = "strict"):
        self.spark, self.path, self.mode = spark, path, mode

    def read_events(self) -> DataFrame:
        return read_jsonl(self.spark, self.path, self.mode)


class FrameSource(EventSource):
    """Rows that are there already."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def read_events(self) -> DataFrame:
        return self.rows


class TableStores:
    """One of each over ``Tables``. ``writer`` names them in the log: with the same name, batches are known again after a restart."""

    def __init__(self, tables: Tables, writer: str | None = None):
        writer = writer or uuid.uuid4().hex
        self.events, self.cursors, self.slots, self.swaps = TableEvents(tables, writer), TableCursors(tables), TableSlots(tables, writer), TableSwaps(tables, writer)


class _Appender:
    def __init__(self, tables: Tables, writer: str):
        self.tables, self.writer = tables, writer

    def _once(self, name: str, batch: int, write: Callable[[], tuple[str, dict] | None], low: int | None = None, high: int | None = None, **more) -> int:
        """Rows that a batch added to a table; nothing is written for a batch that is known already."""
        writer = f"{name}:{self.writer}"
        while True:
            state = self.tables.state()
            seen, known = state.version, state.writers.get(writer)
            if known and batch <= known[0]:
                return known[1]["rows"] if batch == known[0] else 0
            part = write()
            entry = {"writers": {writer: [batch, {"rows": part[1]["rows"] if part else 0}]}, "add": {name: {part[0]: part[1] | more}} if part else {}}
            try:
                self.tables.put(entry, lambda s: name != "events" or not any(p["v"] > seen and overlaps(p, low, high) for p in s.parts.get(name, {}).values()))  # noqa: B023
                return part[1]["rows"] if part else 0
            except Clash:
                if part:
                    self.tables.remove(name, part[0])


class TableEvents(_Appender, EventWriter):
    def write(self, rows: DataFrame, batch: int) -> int:
        fresh = dedup.first_wins(dedup.convertible(rows))
        low, high, balances = fresh.agg(F.min("slot"), F.max("slot"), F.bool_or(F.col("payload").contains("token_balances"))).first()
        now = F.current_timestamp()

        def write():
            if low is None:
                return None
            held = self.tables.read("events", low, high)
            return self.tables.write("events", dedup.new_rows(fresh, held).drop("ordinal").withColumn("observed_at", now).withColumn("inserted_at", now))

        return self._once("events", batch, write, low, high, balances=bool(balances))


class TableCursors(CursorStore):
    def __init__(self, tables: Tables):
        self.tables = tables

    def load(self, stream_name: str) -> int | None:
        return self.tables.state().cursors.get(stream_name, {}).get("persisted")

    def save(self, stream_name: str, slot: int) -> None:
        self.tables.save_cursor(stream_name, persisted=slot)


class TableSlots(_Appender, SlotStore):
    def save(self, states: DataFrame, stream_name: str, batch: int) -> None:
        states = slots.merge_states(states, order="ordinal") if "ordinal" in states.columns else states
        new = lambda: states.withColumn("stream_name", F.lit(stream_name)).withColumn("first_seen_at", F.current_timestamp()).withColumn("batch", F.lit(self.tables.state().version))
        self._once("stream_slots", batch, lambda: self.tables.write("stream_slots", new()), stream=stream_name)

    def advance(self, stream_name: str) -> tuple[int | None, int | None]:
        return pipeline.advance(self.tables, stream_name)


class TableSwaps(_Appender, SwapWriter):
    def write(self, swaps: DataFrame, batch: int) -> int:
        return self._once("swaps", batch, lambda: self.tables.write("swaps", swaps.withColumn("inferred_at", F.current_timestamp())))
