"""The log of commits: several writers on one set of tables, crashes at every step, races, compaction between, looked-up keys."""

import threading

import pytest
from pyspark.sql import functions as F
from test_ingest import balances, events, tx

from tidemark.functions.identity import event_rows
from tidemark.plans import commits, pipeline
from tidemark.plans.tables import Tables
from tidemark.status import Service
from tidemark.streaming.ingest import Ingest


def swap_lines(n, first=0):
    return [tx(1 + (first + i) % 7, f"p{first + i}", 0, balances(("x", 10, 0), ("y", 0, 7 + i))) for i in range(n)]


def finalized(n, parent):
    return f'{{"identity":{{"kind":"slot","cluster":"c","slot":{n},"status":"finalized"}},"payload":{{"parent":{parent}}}}}'


def ids(tables):
    got = [r[0] for r in tables.read("events").select("event_id").collect()]
    assert len(got) == len({*got}), "an event is stored twice"
    return {*got}


def test_a_replay_and_two_streams_share_tables(spark, tmp_path):
    """Streams number their batches from 0 each; none may take the place of what another stored."""
    tables = Tables(spark, str(tmp_path / "t"))
    want = set()
    rows = events(spark, [tx(1 + i // 10, f"r{i}") for i in range(100)])
    pipeline.replay(tables, rows, "r")
    want |= {r[0] for r in event_rows(rows).select("event_id").collect()}
    for name in ("a", "b"):
        more = events(spark, [tx(1 + i // 10, f"{name}{i}") for i in range(10)] + [tx(1, "r0")])
        more.coalesce(1).write.parquet(str(tmp_path / name))
        want |= {r[0] for r in event_rows(more).select("event_id").collect()}
        stream = spark.readStream.schema(more.schema).parquet(str(tmp_path / name))
        done = Ingest(tables, name).run(stream, str(tmp_path / f"ck-{name}"))
        assert (done.events_inserted, done.events_deduplicated) == (10, 1)
        tables.compact("events", 2)
    assert ids(tables) == want and len(want) == 120
    other = Tables(spark, str(tmp_path / "t"))
    assert ids(other) == want and {r["stream_name"] for r in other.read("stream_cursors").collect()} == {"r", "a", "b"}


class Lost(Exception):
    pass


@pytest.mark.parametrize("step,after", [(1, True), (2, True), (3, False), (3, True), (4, True), (5, False), (5, True), (6, False)])
def test_a_crash_at_any_step_is_made_good(spark, tmp_path, step, after, monkeypatch):
    """The steps are: events, states, their entry, swaps, their entry, frontier. One fails, before or after it took place; the next run
    ends as if nothing had happened.
    """
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, swap_lines(12) + [finalized(10, 9), finalized(11, 10), finalized(12, 11)])
    calls, real = [], {"write": Tables.write, "put": Tables.put}

    def fails(name):
        def run(self, *args, **kwargs):
            calls.append(name)
            if len(calls) == step and not after:
                raise Lost
            out = real[name](self, *args, **kwargs)
            if len(calls) == step:
                raise Lost
            return out

        return run

    for name in real:
        monkeypatch.setattr(Tables, name, fails(name))
    with pytest.raises(Lost):
        pipeline.replay(tables, rows, "s", advance_frontier=True)
    monkeypatch.undo()
    again = Tables(spark, str(tmp_path / "t"))
    done = pipeline.replay(again, rows, "s", advance_frontier=True)
    assert again.read("events").count() == 15 and again.read("swaps").count() == 12
    assert again.read("swaps").select("signature").distinct().count() == 12
    mark = again.read("stream_cursors").first()
    assert (mark["last_persisted_slot"], mark["last_contiguous_finalized_slot"], mark["last_finalized_slot"]) == (12, 12, 12)
    assert done.last_contiguous_finalized_slot == 12
    assert pipeline.replay(again, rows, "other", advance_frontier=True).swaps_written == 0 and again.read("swaps").count() == 12


def test_a_writer_that_repeats_its_batch_gets_the_same_answer(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, swap_lines(3))
    first = pipeline.commit(tables, rows, "s", 0, writer="w")
    version = tables.state().version
    again = pipeline.commit(tables, rows, "s", 0, writer="w")
    assert (first.events_inserted, first.swaps_written) == (3, 3) and (again.events_inserted, again.swaps_written) == (3, 0)
    assert tables.state().version == version and tables.read("events").count() == 3
    assert pipeline.commit(tables, rows, "s", 0, writer="another").events_deduplicated == 3


def test_writers_at_the_same_time(spark, tmp_path):
    """Four threads with tables of their own write overlapping events: each is stored once, and every answer adds up."""
    batches = [events(spark, swap_lines(6, first=4 * k)) for k in range(4)]
    told, failed = [], []

    def work(k):
        try:
            told.append(pipeline.commit(Tables(spark, str(tmp_path / "t")), batches[k], f"s{k}"))
        except Exception as e:  # pragma: no cover
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    tables = Tables(spark, str(tmp_path / "t"))
    assert not failed and len(ids(tables)) == 18 == sum(d.events_inserted for d in told)
    assert sum(d.events_deduplicated for d in told) == 6
    pipeline.settle(tables, "s0")
    assert tables.read("swaps").count() == 18 == tables.read("swaps").select("signature").distinct().count()


def test_an_entry_is_put_once_and_states_agree(spark, tmp_path):
    log = commits.Log(spark, str(tmp_path / "t"))
    one, two = log.load(), log.load()
    assert log.append(one, {"runs": {"a": {"status": "x"}}})
    assert not log.append(two, {"runs": {"b": {}}})
    log.follow(two)
    assert log.append(two, {"cursors": {"s": {"persisted": 5, "contiguous": None, "finalized": None, "at": 1}}})
    for n in range(commits.SNAPSHOT_EVERY + 3):
        assert log.append(two, {"cursors": {"s": {"persisted": n, "contiguous": n, "finalized": None, "at": 2}}})
    log.follow(one)
    fresh = log.load()
    assert vars(one) == vars(two) == vars(fresh)
    assert fresh.cursors["s"]["persisted"] == commits.SNAPSHOT_EVERY + 2 and any("state" in p.name for p in (tmp_path / "t/_commits").iterdir())
    log._seen -= 2 * commits.RELOAD_S
    assert vars(log.follow(commits.State())) == vars(fresh)  # not looked at for long: loaded from the snapshot


def scanned(df):
    """Rows that the parquet scans of a finished query handed on."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if "QueryStage" in name:
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_new_ids_read_no_rows_of_a_compacted_folder(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    for k in range(3):
        pipeline.commit(tables, events(spark, [tx(1 + i % 50, f"k{k}-{i}") for i in range(2000)]), "s")
    tables.compact("events", 2)
    assert len(tables.parts("events")) == 1
    stored = [r[0] for r in tables.read("events").select("event_id").limit(3).collect()]
    with tables.by_value():
        new = tables.known_ids(["v1:" + f"{i:064x}" for i in range(500)], 1, 50)
        assert new.collect() == [] and scanned(new) == 0
        some = tables.known_ids(["v1:" + f"{i:064x}" for i in range(400)] + stored, 1, 50)
        assert sorted(r[0] for r in some.collect()) == sorted(stored) and scanned(some) > 0
    done = pipeline.commit(tables, events(spark, [tx(1 + i % 50, f"k0-{i}") for i in range(20)] + [tx(50, "new")]), "s")
    assert (done.events_inserted, done.events_deduplicated) == (1, 20)
    large = pipeline.commit(tables, events(spark, [tx(1 + i % 50, f"k{i % 4}-{i}") for i in range(1500)]), "s")  # by a broadcast join
    assert (large.events_inserted, large.events_deduplicated) == (375, 1125)


def test_recent_rows_come_from_the_newest_folders(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    for k in range(12):
        pipeline.commit(tables, events(spark, [tx(100 * k + i, f"n{k}-{i}") for i in range(20)] + [tx(100 * k + 5, f"odd{k}")] * (k == 3)), "s")
    every = tables.read("events")
    service = Service(tables, "s")
    for limit, most in ((10, 1), (20, 2), (30, 2), (70, 4), (1000, 12)):
        from tidemark.plans import api

        found = tables.newest("events", lambda rows: api.recent_events(rows, None, limit), limit)  # noqa: B023
        assert found._folders <= most and found.collect() == api.recent_events(every, None, limit).collect()
    assert [r["slot"] for r in service.recent_events("transaction", 5)[1]] == [1119, 1118, 1117, 1116, 1115]
    assert service.recent_events("block")[1] == [] and Service(Tables(spark, str(tmp_path / "e")), "s").recent_events() == (200, [])


def test_compaction_leaves_undecoded_events_alone(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path / "t"))
    monkeypatch.setattr(pipeline, "decode_pending", lambda t: 0)
    for k in range(3):
        pipeline.commit(tables, events(spark, swap_lines(2, 2 * k)), "s")
    assert tables.compact("events", 2) == 0
    monkeypatch.undo()
    assert pipeline.settle(tables, "s").swaps_written == 6
    assert tables.compact("events", 2) == 1 and pipeline.settle(tables, "s").swaps_written == 0
    assert tables.read("swaps").count() == 6 and tables.read("events").where(F.col("payload") != "{}").count() == 6
