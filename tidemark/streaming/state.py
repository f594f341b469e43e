"""Markers of streams as keyed state of a running query: cursor, frontier and staleness without a table to ask.

Each stream has its markers and the finalized links above its frontier in the state store; links that the frontier has passed are dropped, so
the state of a stream is as large as its gaps. A timer tells when a stream has been silent for too long. The state lives in the query's
checkpoint, so a restart goes on where the last batch ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.slots import parent_slot

MARKERS = "stream_name string, last_persisted_slot long, last_contiguous_finalized_slot long, last_finalized_slot long, stale boolean"
#: The state store that has more than one state for a key; to be set before the query starts.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def steps(anchor: int | None, known: dict[int, tuple[int | None, bool]]) -> int | None:
    """How far finalized links lead up from the anchor (else from the smallest finalized slot), over all branches: the rule that ``Markers`` keeps to."""
    final = {s: p for s, (p, done) in known.items() if done}
    if anchor is None:
        if not final:
            return None
        anchor = min(final)
    reached = {anchor}
    for s in sorted(s for s in final if s > anchor):
        if final[s] in reached:
            reached.add(s)
    return max(reached)


#: Slots of a bucket of the state, and the least parent of one without links.
BUCKET, NOTHING = 10_000, 2**63 - 1


def folded(slot: np.ndarray, parent: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One state for each slot, by slot, of states in arrival order: the last parent that is not missing (-1), and whether any is final."""
    order = np.argsort(slot, kind="stable")
    slot, parent, final = slot[order], parent[order], final[order]
    slots, first = np.unique(slot, return_index=True)
    if not len(slots):
        return slot, parent, final
    last = np.maximum.reduceat(np.where(parent >= 0, np.arange(len(slot)), -1), first)
    return slots, np.where(last >= 0, parent[last], -1), np.logical_or.reduceat(final, first)


def climbed(slot: np.ndarray, parent: np.ndarray, below: list[np.ndarray]) -> np.ndarray:
    """The slots of a bucket whose links lead down to one of ``below``, ascending parts of lower slots."""
    home = np.zeros(len(slot), bool)
    for part in below:
        if len(parent) and part[-1] >= parent.min() and part[0] <= parent.max():
            home |= (part[np.minimum(np.searchsorted(part, parent), len(part) - 1)] == parent) & (parent < slot)
    at = np.minimum(np.searchsorted(slot, parent), len(slot) - 1)
    up = np.where((parent < slot) & (slot[at] == parent), at, np.arange(len(slot)))
    while not np.array_equal(further := up[up], up):
        up = further
    return slot[home[up]]


class Markers(StatefulProcessor):
    """A row of ``MARKERS`` for each stream in each batch, and one when its timer runs out.

    Open states are kept by buckets of slots, packed, and a bucket is read where new states fall into it or its links can lead down to the frontier:
    a batch holds its own rows as numbers, and a bucket at a time, however many slots are open above a gap.
    """

    def __init__(self, stale_ms: int | None):
        self.stale_ms = stale_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marks = handle.getValueState("marks", "persisted long, contiguous long, finalized long")
        self.packed = handle.getMapState("packed", "bucket long", "states binary")
        #: The least parent that a bucket's final states name, of those not below the frontier.
        self.least = handle.getMapState("least", "bucket long", "parent long")

    def _load(self, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = bytes(self.packed.getValue((bucket,))[0])
        n = len(raw) // 17
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, "?", n, 16 * n)

    def _store(self, least: dict[int, int], bucket: int, slot: np.ndarray, parent: np.ndarray, final: np.ndarray, frontier: int | None) -> None:
        above = slice(None) if frontier is None else slot > frontier
        slot, parent, final = slot[above], parent[above], final[above]
        if not len(slot):
            if bucket in least:
                self._drop(least, bucket)
            return
        self.packed.updateValue((bucket,), (slot.astype("<i8").tobytes() + parent.astype("<i8").tobytes() + final.astype("?").tobytes(),))
        links = parent[final & (parent >= (0 if frontier is None else frontier))]
        now = int(links.min()) if len(links) else NOTHING
        if least.get(bucket) != now:
            least[bucket] = now
            self.least.updateValue((bucket,), (now,))

    def _drop(self, least: dict[int, int], bucket: int) -> None:
        del least[bucket]
        self.packed.removeKey((bucket,))
        self.least.removeKey((bucket,))

    def _walk(self, least: dict[int, int], anchor: int) -> int:
        """How far final links lead up from the anchor, bucket by bucket; a bucket whose links all name higher slots is not read."""
        below, far = [np.array([anchor])], anchor
        for bucket in sorted(b for b in least if (b + 1) * BUCKET > anchor):
            if least[bucket] > far:
                continue
            slot, parent, final = self._load(bucket)
            open_ = final & (slot > anchor)
            reached = climbed(slot[open_], parent[open_], below) if open_.any() else ()
            if len(reached):
                below.append(reached)
                far = int(reached[-1])
        return far

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        persisted, contiguous, head = self.marks.get() or (None, None, None)
        least = {k[0]: v[0] for k, v in self.least.iterator()}
        parts = []
        for chunk in rows:
            if not len(chunk):
                continue
            top = int(chunk["slot"].max())
            persisted = top if persisted is None else max(persisted, top)
            marked = chunk[chunk["marked"].to_numpy(bool)]
            parts.append((marked["ordinal"].to_numpy(), marked["slot"].to_numpy("int64"), marked["parent_slot"].to_numpy("int64"), marked["finalized"].to_numpy(bool)))
        ordinal, slot, parent, final = (np.concatenate([p[i] for p in parts]) if parts else np.array([], t) for i, t in enumerate(("int64", "int64", "int64", bool)))
        order = np.argsort(ordinal, kind="stable")
        slot, parent, final = folded(slot[order], parent[order], final[order])
        if final.any():
            head = max(x for x in (head, int(slot[final][-1])) if x is not None)
        starts = np.flatnonzero(np.diff(slot // BUCKET, prepend=-1))
        for at, end in zip(starts, [*starts[1:], len(slot)], strict=False):  # no starts, no ends
            bucket, new = int(slot[at] // BUCKET), (slot[at:end], parent[at:end], final[at:end])
            held = folded(*map(np.concatenate, zip(self._load(bucket), new, strict=True))) if bucket in least else new
            self._store(least, bucket, *held, contiguous)
        if contiguous is None and final.any():
            contiguous = int(slot[final][0])
        if contiguous is not None:
            contiguous = self._walk(least, contiguous)
            for bucket in [b for b in least if b * BUCKET <= contiguous]:
                if (bucket + 1) * BUCKET <= contiguous + 1:
                    self._drop(least, bucket)
                else:
                    self._store(least, bucket, *self._load(bucket), contiguous)
        self.marks.update((persisted, contiguous, head))
        if self.stale_ms is not None:
            for at in [*self.handle.listTimers()]:
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stale_ms)
        yield self._row(key, persisted, contiguous, head, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._row(key, *(self.marks.get() or (None, None, None)), True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, persisted, contiguous, head, stale: bool) -> pd.DataFrame:
        marks = {"last_persisted_slot": persisted, "last_contiguous_finalized_slot": contiguous, "last_finalized_slot": head}
        return pd.DataFrame({"stream_name": [key[0]], **{k: pd.array([v], "Int64") for k, v in marks.items()}, "stale": [stale]})


def markers(events: DataFrame, stream_name: str | None = None, stale_ms: int | None = None) -> DataFrame:
    """The markers of each stream of envelope rows (with ``ordinal``, and ``stream_name`` unless one is given), in update mode.

    With ``stale_ms`` a stream that is silent for so long gets a row with ``stale`` set. Spark then runs batches without end, as timers may
    expire, so a query that is to end with what there is goes without.
    """
    named = events if stream_name is None else events.withColumn("stream_name", F.lit(stream_name))
    marked = (F.col("kind") == "slot") & F.col("status").isin("finalized", "dead")
    rows = named.where(F.col("slot") <= F.lit(2**63 - 1).cast("decimal(20,0)")).select("stream_name", F.col("slot").cast("long").alias("slot"), F.coalesce(parent_slot(), F.lit(-1)).alias("parent_slot"), (F.col("status") == F.lit("finalized")).eqNullSafe(True).alias("finalized"), marked.eqNullSafe(True).alias("marked"), "ordinal")
    return rows.groupBy("stream_name").transformWithStateInPandas(Markers(stale_ms), MARKERS, "Update", "None" if stale_ms is None else "ProcessingTime")


def use_store(spark: SparkSession) -> None:
    spark.conf.set(*STORE)
