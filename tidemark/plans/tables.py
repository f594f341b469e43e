"""Parquet tables under a log of commits: data folders that never change, listed with their ranges of slots; compaction.

Rows go to a folder of their own for each commit, sorted by slot within its files. The log (see ``commits``) names the folders that count, each with its
lowest and highest slot, so a reader opens only those that can hold its slots, and Parquet's own statistics prune within them. Cursors
and runs are few and live in the log itself. Slot states are appended and merged when read.

Any number of writers may share the tables. A writer that finds another's entry in the way checks it against what it has read, and either puts its
own after it or begins again.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import slots
from .commits import Clash, Log, State, now_ms

#: ``batch`` orders the states of a stream's slots: the entry that their writer had seen last.
_ORDER = [T.StructField("batch", T.LongType())]
SCHEMAS = {"events": S.EVENTS, "stream_cursors": S.STREAM_CURSORS, "ingestion_runs": S.INGESTION_RUNS, "stream_slots": T.StructType([*S.STREAM_SLOTS.fields, *_ORDER]), "swaps": S.SWAPS, "dead_letters": S.DEAD_LETTERS}
APPENDED = ("events", "stream_slots", "swaps", "dead_letters")
BY_SLOT = APPENDED[:3]
FULL = 2_000_000  # rows of a folder that compaction leaves alone
FILE_ROWS = 1_000_000  # of a compacted file
#: So many ids are looked up by value, which a compacted file's Bloom filter answers without reading rows.
BY_VALUE = 1000
_IN = "spark.sql.parquet.pushdown.inFilterThreshold"


def overlaps(part: dict, low: int | None, high: int | None) -> bool:
    return (low is None or part["high"] >= low) and (high is None or part["low"] <= high)


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in APPENDED:
            self._fs.mkdirs(self._path(f"{self.root}/{name}"))
        self.log = Log(spark, self.root)
        self._state, self._guard = self.log.load(), threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def state(self) -> State:
        """The log as it stands now. Another thread may move it on; take what is needed at once."""
        with self._guard:
            self._state = self.log.follow(self._state)
            return self._state

    # ---- writing ----

    def write(self, name: str, rows: DataFrame, options: dict | None = None) -> tuple[str, dict] | None:
        """Rows in a folder of their own, sorted by slot within each file: its name and range; None if there are none.

        No reader sees it before an entry of the log names it.
        """
        told = Observation()
        rows = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in SCHEMAS[name].fields])
        slot = "slot" if name in BY_SLOT else "0L"
        rows = rows.observe(told, *[F.expr(e) for e in ("count(1) AS rows", f"min({slot}) AS low", f"max({slot}) AS high")])
        rows = rows.sortWithinPartitions("slot") if name in BY_SLOT else rows
        folder = f"{now_ms():013d}-{uuid.uuid4().hex}"
        rows.write.options(**(options or {})).parquet(f"{self.path(name)}/{folder}")
        part = dict(told.get)
        if not part.get("rows"):
            self.remove(name, folder)
            return None
        return folder, part

    def write_by(self, name: str, rows: DataFrame, by: str) -> dict[int, tuple[str, dict]]:
        """The same for many folders at once: rows with a whole number ``by`` in a folder for each number; which numbers have rows is in the answer."""
        own = f"{now_ms():013d}-{uuid.uuid4().hex}"
        path = f"{self.root}/_scratch/{own}"
        slot = "slot" if name in BY_SLOT else "0L"
        typed = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in SCHEMAS[name].fields], f"CAST(`{by}` AS BIGINT) AS `{by}`")
        typed.repartition(by).sortWithinPartitions(by, F.expr(slot)).write.partitionBy(by).parquet(path)
        laid = self.spark.read.schema(T.StructType([*SCHEMAS[name].fields, T.StructField(by, T.LongType())])).parquet(path)
        told = laid.groupBy(by).agg(F.count("*").alias("rows"), F.expr(f"min({slot})").alias("low"), F.expr(f"max({slot})").alias("high")).collect()
        out = {}
        for t in told:
            out[t[by]] = f"{own}-{t[by]}", {k: t[k] for k in ("rows", "low", "high")}
            if not self._fs.rename(self._path(f"{path}/{by}={t[by]}"), self._path(f"{self.path(name)}/{own}-{t[by]}")):
                raise OSError(f"cannot move {path}/{by}={t[by]}")
        self._fs.delete(self._path(path), True)
        return out

    def remove(self, name: str, folder: str) -> None:
        self._fs.delete(self._path(f"{self.path(name)}/{folder}"), True)

    def put(self, entry: dict, stands: Callable[[State], bool] | None = None) -> int:
        """Add an entry to the log; its number. ``stands`` is asked with the state before it, and Clash is raised where it says no."""
        with self._guard:
            while True:
                state = self.state()
                if stands and not stands(state):
                    raise Clash
                if self.log.append(state, entry):
                    return state.version

    def save_cursor(self, stream: str, persisted: int | None = None, contiguous: int | None = None, finalized: int | None = None, **more) -> None:
        """Raise a stream's markers; none goes back."""
        self.put({"cursors": {stream: marks(persisted, contiguous, finalized)}, **more})

    def log_run(self, run_id: str, **told) -> None:
        self.put({"runs": {run_id: told}})

    # ---- reading ----

    def parts(self, name: str, low: int | None = None, high: int | None = None, stream: str | None = None) -> dict[str, dict]:
        """The folders of a table that can hold slots from ``low`` to ``high``, and rows of a stream."""
        with self._guard:
            every = self.state().parts.get(name, {})
            return {k: p for k, p in every.items() if overlaps(p, low, high) and (stream is None or p.get("stream", stream) == stream)}

    def rows(self, name: str, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.path(name)}/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*paths)

    def read(self, name: str, low: int | None = None, high: int | None = None, stream: str | None = None) -> DataFrame:
        """A table; of an appended one only the slots named, where that is asked."""
        if name == "stream_cursors":
            with self._guard:
                kept = [(s, m.get("persisted") or 0, m.get("contiguous"), m.get("finalized"), _time(m["at"]), "{}") for s, m in self.state().cursors.items()]
            return self.spark.createDataFrame(kept, SCHEMAS[name])
        if name == "ingestion_runs":
            with self._guard:
                kept = [(r, _time(m.get("started_at")), _time(m.get("stopped_at")), m.get("status"), m.get("git_sha"), m.get("config_hash")) for r, m in self.state().runs.items()]
            return self.spark.createDataFrame(kept, SCHEMAS[name])
        found = self.rows(name, self.parts(name, low, high, stream))
        for bound, inside in ((low, F.col("slot") >= F.lit(low)), (high, F.col("slot") <= F.lit(high))):
            found = found if bound is None else found.where(inside)
        if name != "stream_slots":
            return found
        found = found if stream is None else found.where(F.col("stream_name") == stream)
        return merged(found).select(*S.STREAM_SLOTS.names)

    def known_ids(self, ids: list[str], low: int, high: int) -> DataFrame:
        """Which of at most ``BY_VALUE`` event ids are stored, by filters that reach the files' statistics and Bloom filters."""
        listed = ", ".join("'" + i.replace("\\", "\\\\").replace("'", "\\'") + "'" for i in ids)
        return self.read("events", low, high).where(f"event_id IN ({listed})" if ids else "false").select("event_id")

    def by_value(self):
        """While it is open, filters on as many values as ``known_ids`` takes are handed to Parquet."""
        return _Setting(self.spark, _IN, str(BY_VALUE))

    def newest(self, name: str, top: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
        """``top`` of a table, which takes the ``limit`` rows of the highest slots: the folders with the highest slots first, twice as many each time,
        until the limit is full and no other folder reaches the last slot taken.
        """
        order = sorted(self.parts(name).items(), key=lambda x: -x[1]["high"])
        n = 1
        while True:
            found = top(self.rows(name, [k for k, _ in order[:n]]))
            taken = found.collect()
            if n >= len(order) or len(taken) >= limit and taken[-1]["slot"] > order[n][1]["high"]:
                out = self.spark.createDataFrame(taken, found.schema)
                out._folders = min(n, len(order))
                return out
            n *= 2

    # ---- upkeep ----

    @contextmanager
    def scratch(self, *by: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """While it is open: a function that writes a frame beside the tables and reads it back, which cuts its lineage."""
        path = f"{self.root}/_scratch/{uuid.uuid4().hex}"

        def cut(df: DataFrame) -> DataFrame:
            own = f"{path}/{uuid.uuid4().hex}"
            df.write.partitionBy(*by).parquet(own)
            return self.spark.read.schema(df.schema).parquet(own)

        try:
            yield cut
        finally:
            self._fs.delete(self._path(path), True)

    def compact(self, name: str, least: int = 8) -> int:
        """Put ``least`` or more neighbouring small folders into one, sorted by slot; the number of new folders.

        Readers and writers go on meanwhile: the entry swaps the folders at once. The old ones are left to ``vacuum``, as a reader may be in them.
        """
        done = 0
        for group in self._groups(name, least):
            rows, n = self.rows(name, group), sum(p["rows"] for p in group.values())
            options = {}
            if name == "stream_slots":
                rows = merged(rows)
            if name == "events":
                options = {"parquet.bloom.filter.enabled#event_id": "true", "parquet.bloom.filter.expected.ndv#event_id": str(max(64, min(n, FILE_ROWS)))}
            rows = rows.coalesce(1) if n <= FILE_ROWS or name not in BY_SLOT else rows.repartitionByRange(-(-n // FILE_ROWS), "slot")
            new = self.write(name, rows, options)
            marks = {k: v for k, v in next(iter(group.values())).items() if k == "stream"}
            try:
                self.put({"drop": {name: [*group]}, "add": {name: {new[0]: new[1] | marks}}}, lambda s: all(g in s.parts.get(name, {}) for g in group))
                done += 1
            except Clash:
                self.remove(name, new[0])
        return done

    def _groups(self, name: str, least: int) -> list[dict[str, dict]]:
        with self._guard:
            state = self.state()
            small = [(k, dict(p)) for k, p in state.parts.get(name, {}).items() if p["rows"] < FULL and not (p.get("balances") and p["v"] > state.decoded)]
        groups: list[dict[str, dict]] = []
        held, size = {}, 0
        for k, p in sorted(small, key=lambda x: (x[1].get("stream", ""), x[1]["low"])):
            if held and (size >= FULL or next(iter(held.values())).get("stream") != p.get("stream")):
                groups.append(held)
                held, size = {}, 0
            held[k] = p
            size += p["rows"]
        return [g for g in [*groups, held] if len(g) >= max(2, least)]

    def vacuum(self, older_ms: int = 24 * 3600 * 1000) -> int:
        """Delete folders that no entry names any more (compacted, or of a writer that died) and that are older than that; the number.

        The age protects commits that are under way and readers of folders that were compacted. Old entries of the log go too.
        """
        gone, before = 0, now_ms() - older_ms
        with self._guard:
            live = {name: {*self.state().parts.get(name, {})} for name in APPENDED}
        for name in APPENDED:
            for s in self._fs.listStatus(self._path(self.path(name))):
                folder = s.getPath().getName()
                if folder not in live[name] and s.getModificationTime() <= before:
                    self.remove(name, folder)
                    gone += 1
        self.log.trim(older_ms)
        return gone


class _Setting:
    """A setting of the session for a while."""

    def __init__(self, spark: SparkSession, key: str, value: str):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.key)
        self.spark.conf.set(self.key, self.value)

    def __exit__(self, *_) -> None:
        self.spark.conf.set(self.key, self.before)


def merged(rows: DataFrame) -> DataFrame:
    """One state for each slot of a stream out of all that were stored."""
    return slots.merge_states(rows, "stream_name", order="batch", also={"first_seen_at": F.min("first_seen_at"), "batch": F.max("batch")})


def marks(persisted: int | None = None, contiguous: int | None = None, finalized: int | None = None) -> dict:
    return {"persisted": persisted, "contiguous": contiguous, "finalized": finalized, "at": now_ms()}


def _time(ms: int | None) -> datetime | None:
    return None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc)
