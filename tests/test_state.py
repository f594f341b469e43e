"""Markers as keyed state: gaps that fill, restarts from the checkpoint, streams apart, silence."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_core import slot_event, tx
from test_ingest import events

from tidemark.streaming import state


@pytest.fixture(autouse=True)
def store(spark):
    before = spark.conf.get(state.STORE[0])
    state.use_store(spark)
    yield
    spark.conf.set(state.STORE[0], before)


def dropped(spark, folder, lines, stream):
    rows = events(spark, lines).withColumn("stream_name", F.lit(stream))
    rows.coalesce(1).write.mode("append").parquet(str(folder))
    return rows.schema


def run(spark, schema, tmp_path):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "drop"))
    save = lambda df, batch: df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(str(tmp_path / "told"))
    state.markers(stream).writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.parquet(str(tmp_path / "told")).orderBy("batch").collect()
    return {r["stream_name"]: tuple(r)[1:4] for r in told if not r["stale"]}


def test_gaps_fill_over_restarts(spark, tmp_path):
    schema = dropped(spark, tmp_path / "drop", [slot_event(100, 99), slot_event(101, 100), slot_event(103, 102), tx(110)], "g")
    dropped(spark, tmp_path / "drop", [slot_event(7, 6), slot_event(8, 7)], "h")
    assert run(spark, schema, tmp_path) == {"g": (110, 101, 103), "h": (8, 8, 8)}
    dropped(spark, tmp_path / "drop", [slot_event(5, 4)], "g")  # below the frontier
    dropped(spark, tmp_path / "drop", [slot_event(9, 7), slot_event(10, 8), slot_event(12, 10, "dead")], "h")  # a fork
    assert run(spark, schema, tmp_path) == {"g": (110, 101, 103), "h": (12, 10, 10)}
    dropped(spark, tmp_path / "drop", [slot_event(102, 101)], "g")
    assert run(spark, schema, tmp_path)["g"] == (110, 103, 103)  # from what the checkpoint held


def test_a_silent_stream_is_told(spark, tmp_path):
    schema = dropped(spark, tmp_path / "drop", [slot_event(1, 0)], "s")
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "drop"))
    told = []
    query = state.markers(stream, stale_ms=1500).writeStream.outputMode("update").foreachBatch(lambda df, b: told.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not any(t[-1] for t in told):
            time.sleep(0.3)
    finally:
        query.stop()
    assert told[0] == ("s", 1, 1, 1, False) and told[-1] == ("s", 1, 1, 1, True)


@pytest.mark.parametrize("known,anchor,want", [
    ({10: (9, True), 11: (10, True), 12: (11, True)}, 10, 12), ({10: (9, True), 12: (10, True), 15: (12, True)}, 10, 15), ({10: (9, True), 11: (10, True), 13: (12, True)}, 10, 11),
    ({5: (4, True)}, 20, 20), ({7: (6, True), 8: (7, True)}, None, 8), ({10: (9, True), 11: (10, True), 12: (10, True), 13: (12, True)}, 10, 13), ({0: (0, True), 1: (0, True)}, None, 1),
    ({3: (2, False)}, None, None), ({3: (2, True), 4: (3, False), 5: (4, True)}, 3, 3),
])
def test_steps(known, anchor, want):
    assert state.steps(anchor, known) == want


class Kept:
    """A state of either form, as the state store has it; counts its reads."""

    def __init__(self):
        self.value, self.items, self.reads = None, {}, 0

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def iterator(self):
        return iter([*self.items.items()])

    def getValue(self, key):  # noqa: N802
        self.reads += 1
        return self.items[key]

    def updateValue(self, key, value):  # noqa: N802
        self.items[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.items[key]


class Handle(dict):
    def getValueState(self, name, *_):  # noqa: N802
        return self.setdefault(name, Kept())

    getMapState = getValueState  # noqa: N815


def fed(of, rows, chunk=7):
    frame = pd.DataFrame(rows, columns=["ordinal", "slot", "parent_slot", "finalized", "marked"])
    (out,) = of.handleInputRows(("s",), iter([frame[i : i + chunk] for i in range(0, len(frame), chunk)]), None)
    return tuple(int(x) if pd.notna(x) else None for x in out.iloc[0, 1:4])


@pytest.mark.parametrize("seed", range(60))
def test_packed_state_keeps_to_the_rule(seed, monkeypatch):
    monkeypatch.setattr(state, "BUCKET", 1 + seed % 9)
    draw, handle, of = random.Random(seed), Handle(), state.Markers(None)
    of.init(handle)
    persisted = anchor = head = None
    known = {}
    for _ in range(6):
        rows = [(i, s := draw.randrange(40), draw.choice([-1, s, s - 1, s - 1, s - 1, s - 2, draw.randrange(40)]), draw.random() < 0.8, draw.random() < 0.9) for i in range(draw.randrange(1, 25))]
        rows = [(i, s, max(p, -1), f, m) for i, s, p, f, m in rows]
        for _, s, p, f, m in rows:
            persisted = max(s, -1 if persisted is None else persisted)
            if m:
                old = known.get(s, (None, False))
                known[s] = (old[0] if p < 0 else p, old[1] or f)
                head = max(s, -1 if head is None else head) if f else head
        anchor = state.steps(anchor, known)
        known = {s: x for s, x in known.items() if anchor is None or s > anchor}
        draw.shuffle(rows)
        assert fed(of, rows) == (persisted, anchor, head)


def test_open_slots_above_a_gap_are_not_read_again():
    handle, of = Handle(), state.Markers(None)
    of.init(handle)
    fed(of, [(0, 1, 0, True, True)])
    before = handle["packed"].reads
    for n in range(1, 21):
        low = n * 50_000
        assert fed(of, [(i, low + i, low + i - 1, True, True) for i in range(30_000)], 10_000) == (low + 29_999, 1, low + 29_999)
    assert handle["packed"].reads == before and sum(len(v[0]) for v in handle["packed"].items.values()) == 17 * 600_000
