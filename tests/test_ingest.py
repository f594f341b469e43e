"""Commits cut by count, crashes, compaction, swaps, the live loop, the command and its HTTP answers."""

import base64
import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark import app, serve
from tidemark.functions.identity import wide
from tidemark.plans import pipeline
from tidemark.plans.tables import Tables
from tidemark.sources.live import TRANSPORTS, Subscription
from tidemark.sources.replay import parse_lines
from tidemark.status import Service
from tidemark.stores import FrameSource, JsonlSource, TableStores
from tidemark.streaming.live import LiveLoop, decoded
from tidemark.streaming.recovery import Backoff, LiveStatus, SourceError


def tx(slot, signature="s", index=0, payload="{}"):
    return json.dumps({"identity": {"kind": "transaction", "cluster": "c", "slot": slot, "signature": signature, "index": index}, "payload": json.loads(payload)})


def events(spark, lines):
    return parse_lines(spark.createDataFrame(list(enumerate(lines)), "ordinal long, value string")).drop("parse_error")


def test_replay_in_counted_batches(spark, tmp_path):
    rows = events(spark, [tx(i + 1, f"s{i}") for i in range(5)])
    told = []
    done = pipeline.replay(Tables(spark, f"{tmp_path}/a"), rows, "s", batch_size=2, commit_rows=2, on_progress=lambda s: told.append((s.events_seen, s.last_persisted_slot)))
    assert (done.batches_written, done.events_inserted, done.last_persisted_slot) == (3, 5, 5)
    assert told == [(0, None), (2, 2), (4, 4), (5, 5), (5, 5)]
    one = pipeline.replay(Tables(spark, f"{tmp_path}/b"), rows, "s", batch_size=2)
    assert (one.batches_written, one.events_inserted) == (3, 5) and one.write_seconds_max > 0
    assert pipeline.replay(Tables(spark, f"{tmp_path}/c"), rows, "s").batches_written == 1
    halted = pipeline.replay(Tables(spark, f"{tmp_path}/d"), rows, "s", batch_size=2, commit_rows=2, stop=lambda: True)
    assert (halted.events_seen, halted.last_persisted_slot) == (2, 2)
    tables = Tables(spark, f"{tmp_path}/d")
    rest = pipeline.replay(tables, rows, "s", batch_size=2, commit_rows=2)
    assert (rest.resume_skipped, rest.events_inserted, rest.batches_written, tables.read("events").count()) == (2, 3, 2, 5)
    assert not list((tmp_path / "d/_scratch").glob("*"))


def test_duplicates_across_commits_and_history(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, [tx(1, "a"), tx(25_000, "b"), tx(1, "a"), tx(25_000, "b", 1), tx(1, "a")])
    done = pipeline.replay(tables, rows, "s", batch_size=1, commit_rows=2)
    assert (done.events_attempted, done.events_inserted, done.events_deduplicated) == (5, 3, 2)
    assert sorted(p["low"] for p in tables.parts("events").values()) == [1, 25_000] or len(tables.parts("events")) <= 2
    assert tables.read("events", 20_000).count() == 2 and tables.read("events", 1, 1).count() == 1


def test_compaction_keeps_rows_and_states(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    slot = lambda n, parent, status="finalized": json.dumps({"identity": {"kind": "slot", "cluster": "c", "slot": n, "status": status}, "payload": {"parent": parent}})
    for i in range(4):
        pipeline.commit(tables, events(spark, [slot(10 + i, 9 + i), tx(10 + i, f"s{i}"), slot(10, 8 + i % 2, "dead")]), "s", i, True)
    states = lambda: sorted(tuple(r)[:5] for r in tables.read("stream_slots").collect())
    ids, was = {r["event_id"] for r in tables.read("events").collect()}, states()
    for name in ("events", "stream_slots"):
        assert tables.compact(name, 3) == 1
        assert len(tables.parts(name)) == 1
    assert {r["event_id"] for r in tables.read("events").collect()} == ids and states() == was
    again = pipeline.commit(tables, events(spark, [tx(10, "s0"), slot(14, 13)]), "s", 4, True)
    assert (again.events_inserted, again.last_contiguous_finalized_slot) == (1, 14)
    assert was[0] == ("s", 10, 9, True, True)
    # A compaction that died before its entry does not count, and leftovers go with a vacuum.
    tables.write("events", tables.read("events").limit(1))
    assert tables.read("events").count() == len(ids) + 1
    assert tables.vacuum(0) == 4 + 4 + 1 and tables.read("events").count() == len(ids) + 1


def balances(*legs):
    return json.dumps({"token_balances": [{"account": f"a{i}", "mint": m, "pre": a, "post": b} for i, (m, a, b) in enumerate(legs)]})


def test_swaps_are_decoded_stored_and_served(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, [tx(1, "a", 0, balances(("x", 10, 0), ("y", 0, 7))), tx(2, "b", 0, balances(("x", 10, 0))), tx(3, "c"), tx(1, "a", 0, balances(("x", 10, 0), ("y", 0, 7))), tx(4, "d", 0, balances(("x", 0, 1), ("y", 2, 0)))])
    assert pipeline.replay(tables, rows, "s").swaps_written == 2
    assert pipeline.replay(tables, rows, "again").swaps_written == 0
    code, body = Service(tables, "s").recent_swaps()
    assert code == 200 and [(r["slot"], r["token_in"], r["token_in_amount"], r["token_out"]) for r in body] == [(4, "y", 2, "x"), (1, "x", 10, "y")]
    assert TableStores(tables).swaps.write(tables.read("swaps").where("false").drop("inferred_at"), 9) == 0


def test_stores(spark, tmp_path):
    stores, rows = TableStores(Tables(spark, str(tmp_path / "t"))), events(spark, [tx(1, "a"), tx(1, "a"), tx(2, "b")])
    from tidemark.functions.identity import event_rows

    ready = event_rows(FrameSource(rows).read_events(), "ordinal")
    assert [stores.events.write(ready, 0), stores.events.write(ready, 0), stores.events.write(ready, 1)] == [2, 2, 0]
    assert stores.cursors.load("s") is None
    stores.cursors.save("s", 5)
    stores.cursors.save("s", 3)
    assert stores.cursors.load("s") == 5
    states = spark.createDataFrame([(1, None, True, False), (2, 1, True, False)], "slot long, parent_slot long, finalized boolean, dead boolean")
    stores.slots.save(states, "s", 0)
    assert stores.slots.advance("s") == (2, 2)
    (tmp_path / "x.jsonl").write_text(tx(1) + "\n")
    assert JsonlSource(spark, str(tmp_path / "x.jsonl")).read_events().count() == 1


def slot_update(n, parent, status=2):
    return json.dumps({"kind": "slot", "slot": {"slot": n, "parent": parent, "status": status}})


def transaction_update(n, program=1):
    code = lambda b: base64.b64encode(b).decode()
    message = {"account_keys": [code(b"k0"), code(b"k1")], "instructions": [{"program_id_index": program, "accounts": code(b"\0"), "data": code(b"\1")}]}
    return json.dumps({"kind": "transaction", "transaction": {"slot": n, "transaction": {"signature": code(b"sig%d" % n), "is_vote": False, "index": 0, "message": message}}})


def test_live_updates_are_decoded(spark):
    lines = [slot_update(5, 4), "not json", slot_update(6, 5, 77), transaction_update(7), transaction_update(8, 9), json.dumps({"kind": "ping"})]
    rows = decoded(spark.createDataFrame(list(enumerate(lines)), "ordinal long, value string"), "c").collect()
    assert sorted((r["kind"], int(r["slot"] or 0), r["error"]) for r in rows if r["error"] is None) == [("instruction", 7, None), ("slot", 5, None), ("transaction", 7, None)]
    assert sorted(r["error"] for r in rows if r["error"]) == ["missing update", "program id index out of range", "unknown slot status: 77"]


def test_live_loop_reconnects_skips_and_stops(spark, tmp_path):
    asked, slept, told = [], [], []

    def feed(request, start):
        asked.append(request.get("from_slot"))
        if len(asked) == 1:
            yield from [slot_update(10, 9), slot_update(11, 10), "broken", slot_update(13, 12)]
            raise SourceError("receive", "lost")
        if len(asked) == 2:
            yield from [slot_update(11, 10), slot_update(12, 11)]  # then the stream ends
        else:
            raise SourceError("subscribe", "no", "unauthenticated")

    TRANSPORTS["scripted"] = feed
    loop = LiveLoop(Tables(spark, str(tmp_path / "t")), "s", Subscription(), "scripted", linger_ms=50, backoff=Backoff(10, 100), sleep=slept.append, on_progress=lambda s: told.append(s.events_seen))
    with pytest.raises(SourceError, match="no"):
        loop.run()
    assert asked == [None, 11, 13]
    assert len(slept) == 2 and told[0] == 0 and told[-1] == loop.totals.events_seen == 5
    assert (loop.totals.events_inserted, loop.totals.events_deduplicated, loop.totals.last_contiguous_finalized_slot) == (4, 1, 13)
    assert loop.status.decode_errors_total == 1 and loop.status.reconnect_attempts == 2 and loop.status.gap_risk_count == 0
    text = loop.metrics.render()
    assert "decode_errors_total 1" in text and "reconnect_attempts_total 2" in text and 'ingest_events_total{source="live",event_type="slot"} 5' in text and "last_persisted_slot 13" in text
    assert 'channel_capacity{stream_name="s"} 10000' in text and "batch_write_latency_seconds_count" in text


def test_live_loop_stops_when_asked(spark, tmp_path):
    release = threading.Event()

    def feed(request, start):
        yield slot_update(1, 0)
        release.wait(60)

    TRANSPORTS["waiting"] = feed
    loop = LiveLoop(Tables(spark, str(tmp_path / "t")), "s", Subscription(), "waiting", linger_ms=20)
    loop.on_progress = lambda s: s.events_seen and loop.stop()
    assert loop.run().events_inserted == 1
    release.set()


def test_command_replays_and_serves(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join([tx(1, "a"), tx(2, "b"), tx(2, "b"), json.dumps({"identity": {"kind": "slot", "cluster": "c", "slot": 2, "status": "finalized"}, "payload": {}})]) + "\n")
    env = {"STORAGE_ROOT": str(tmp_path / "t"), "HTTP_ADDR": "127.0.0.1:0"}
    assert app.main(["--replay", str(path), "--exit-after-replay"], env, spark) == 0
    run = Tables(spark, str(tmp_path / "t")).read("ingestion_runs").collect()
    assert [r["status"] for r in run] == ["completed"] and run[0]["stopped_at"] >= run[0]["started_at"]
    bad = tmp_path / "bad.jsonl"
    bad.write_text("nope\n")
    assert app.main(["--replay", str(bad), "--exit-after-replay"], env, spark) == 3
    assert app.main(["--batch-size", "0"], env, spark) == 2
    assert app.main(["--live", "--endpoint", "x", "--transport", "none"], env, spark) == 7
    lines = tmp_path / "live.jsonl"
    lines.write_text(slot_update(3, 2) + "\n")
    assert app.main(["--live", "--endpoint", str(lines), "--reconnect-max-attempts", "1", "--reconnect-initial-ms", "1", "--reconnect-max-ms", "5", "--stream-name", "l"], env, spark) == 5
    service = Service(Tables(spark, str(tmp_path / "t")), "l", live=LiveStatus())
    get = lambda target: serve.respond(service, target)
    assert get("/healthz") == (200, "text/plain", "ok") and json.loads(get("/readyz")[2]) == {"ready": True}
    assert json.loads(get("/v1/streams/l/lag")[2])["last_persisted_slot"] == 3
    assert len(json.loads(get("/v1/events/recent?limit=2")[2])) == 2
    assert {r["event_type"] for r in json.loads(get("/v1/events/recent?event_type=slot")[2])} == {"slot"}
    assert json.loads(get("/status")[2])["mode"] == "replay" and "# TYPE" in get("/metrics")[2]
    assert get("/nothing")[0] == 404 and get("/v1/swaps/recent?limit=x")[0] == 400


def test_http_server(spark, tmp_path):
    from urllib.request import urlopen

    server = serve.start(Service(Tables(spark, str(tmp_path / "t")), "s"), "127.0.0.1:0", lambda: 0)
    with urlopen(f"http://127.0.0.1:{server.server_address[1]}/healthz", timeout=10) as r:
        assert r.read() == b"ok"
    server.shutdown()


def test_wide_rows_without_slots(spark, tmp_path):
    empty = wide(spark.createDataFrame([], "kind string, cluster string, slot long, signature string, index long, payload string, ordinal long"))
    assert pipeline.commit(Tables(spark, str(tmp_path / "t")), empty, "s", 0).events_seen == 0
    assert pipeline.replay(Tables(spark, str(tmp_path / "t")), empty.where(F.lit(True)), "s").batches_written == 0


def test_batches_of_any_size_are_numbered_in_ranges_of_one_width(spark):
    rows = spark.range(200_000).select(F.col("id").alias("ordinal"))
    laid = pipeline.numbered(rows, 90_000)
    assert [tuple(r) for r in laid.groupBy("batch_no").count().orderBy("batch_no").collect()] == [(0, 90_000), (1, 90_000), (2, 20_000)]
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    assert f"/ {float(pipeline.RANGE)}" in plan and pipeline.RANGE < 90_000


def test_small_commits_are_prepared_together(spark, tmp_path, monkeypatch):
    slot = lambda n: json.dumps({"identity": {"kind": "slot", "cluster": "c", "slot": n, "status": "finalized"}, "payload": {"parent": n - 1}})
    lines = [x for i in range(12) for x in (tx(1 + i, f"s{i % 9}", payload=balances(("x", 10, 0), ("y", 0, 7 + i))), slot(1 + i))] + [tx(1, "s0", payload=balances(("x", 10, 0), ("y", 0, 7)))]
    rows, jobs, alone = events(spark, lines), [], []
    write_by, commit = Tables.write_by, pipeline.commit
    monkeypatch.setattr(Tables, "write_by", lambda self, name, *a: jobs.append(name) or write_by(self, name, *a))
    monkeypatch.setattr(pipeline, "commit", lambda *a, **k: alone.append(1) or commit(*a, **k))
    tables, told = Tables(spark, str(tmp_path / "a")), []
    done = pipeline.replay(tables, rows, "s", batch_size=2, commit_rows=2, advance_frontier=True, on_progress=lambda s: told.append(s.events_seen))
    assert jobs == ["events", "stream_slots"] and not alone
    assert told == [0, *range(2, 25, 2), 25, 25] and tables.state().version >= 13
    one = Tables(spark, str(tmp_path / "b"))
    want = pipeline.replay(one, rows, "s", batch_size=2, advance_frontier=True)
    for k in ("events_seen", "batches_written", "events_inserted", "events_deduplicated", "swaps_written", "last_persisted_slot", "last_contiguous_finalized_slot", "last_finalized_slot"):
        assert getattr(done, k) == getattr(want, k), k
    for name, columns in (("events", ["event_id"]), ("stream_slots", ["slot", "parent_slot", "finalized"]), ("swaps", ["slot", "token_in_amount", "token_out_amount"])):
        assert sorted(map(tuple, tables.read(name).select(*columns).collect())) == sorted(map(tuple, one.read(name).select(*columns).collect())), name
    # Another writer stores events of the same slots between the entries: what is left is committed one by one, and nothing is stored twice.
    busy, other = Tables(spark, str(tmp_path / "c")), []

    def meddle(summary):
        if summary.events_seen == 4 and not other:
            other.append(commit(Tables(spark, str(tmp_path / "c")), events(spark, [lines[6], lines[8]]), "t"))

    pipeline.replay(busy, rows, "s", batch_size=2, commit_rows=2, on_progress=meddle)
    assert other and alone
    stored = [r[0] for r in busy.read("events").select("event_id").collect()]
    assert len(stored) == len({*stored}) == want.events_inserted
    live = {f for f in busy.parts("events")}
    assert len(live) >= 1 and not list((tmp_path / "c/_scratch").glob("*/*"))




def test_a_frontier_at_a_gap_is_not_walked_again(spark, tmp_path, monkeypatch):
    slot = lambda n, p: json.dumps({"identity": {"kind": "slot", "cluster": "c", "slot": n, "status": "finalized"}, "payload": {"parent": p}})
    walks, walk = [], pipeline.slots.finalized_frontier
    monkeypatch.setattr(pipeline.slots, "finalized_frontier", lambda *a: walks.append(1) or walk(*a))
    tables = Tables(spark, str(tmp_path / "t"))
    marks = lambda i, *lines: (lambda d: (d.last_contiguous_finalized_slot, d.last_finalized_slot))(pipeline.commit(tables, events(spark, [*lines]), "s", i, True))
    assert marks(0, slot(1, 0), slot(2, 1)) == (2, 2) and len(walks) == 1
    assert marks(1, slot(5, 4), slot(6, 5)) == (2, 6) and marks(2, slot(9, 8)) == (2, 9) and len(walks) == 1
    assert marks(3, slot(4, 3), slot(3, 2)) == (6, 9) and len(walks) == 2


def test_dropped_files_are_bounded_and_in_order(spark, tmp_path, monkeypatch):
    from tidemark.plans import driver_queries as D

    monkeypatch.setattr(D, "FILE_ROWS", 100)
    monkeypatch.setattr(D, "BATCH_ROWS", 250)
    path = str(tmp_path / "drop")
    files = D._dropped(spark, spark.range(1000).select((F.col("id") + 5).alias("ordinal")), path)
    told = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.min("ordinal").alias("low"), F.first("_metadata.file_modification_time").alias("at")).orderBy("at").collect()
    assert files == 3 and len(told) == 12 and max(t["n"] for t in told) <= 150, told  # by hash, so about 100
    assert [(t["low"] - 5) // 250 for t in told] == [k for k in range(4) for _ in range(3)]
