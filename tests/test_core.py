"""Golden cases of identity, replay, dedup, frontier, decoding, recovery, configuration and status."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config, ConfigError, csv_list
from tidemark.functions.base58 import encode
from tidemark.functions.identity import canonical_key, event_id, wide
from tidemark.metrics import Metrics
from tidemark.operators import decode, normalize, slots
from tidemark.plans import api, pipeline
from tidemark.plans.tables import Tables
from tidemark.schema import UPDATE
from tidemark.sources.live import TRANSPORTS, LiveSource, Subscription
from tidemark.sources.replay import ReplayError, parse_lines, read_jsonl
from tidemark.status import Service
from tidemark.streaming.recovery import Backoff, LiveStatus, SourceError, reconnect_loop, retryable


def tx(slot, signature="s", index=0, payload=None):
    return f'{{"identity":{{"kind":"transaction","cluster":"localnet","slot":{slot},"signature":"{signature}","index":{index}}},"payload":{payload or "{}"}}}'


def events(spark, lines):
    return parse_lines(spark.createDataFrame(list(enumerate(lines)), "ordinal long, value string")).drop("parse_error")


def test_key_and_id(spark):
    df = wide(spark.createDataFrame([("transaction", "localnet", 42, "sig-1", 7)], "kind string, cluster string, slot long, signature string, index long"))
    row = df.select(canonical_key().alias("k"), event_id().alias("i")).first()
    assert row["k"] == "v=1|kind=transaction|cluster=localnet|slot=42|signature=sig-1|index=7"
    assert len(row["i"]) == 67


def test_none_and_empty_signature_differ(spark):
    df = wide(spark.createDataFrame([("account", "c", 1, "a", 1, None, False), ("account", "c", 1, "a", 1, "", False)], "kind string, cluster string, slot long, account string, write_version long, txn_signature string, is_startup boolean"))
    assert df.select(event_id().alias("i")).distinct().count() == 2


@pytest.mark.parametrize("line,error", [(" ", "empty line"), ("x", "invalid JSON"), ('{"identity":{"kind":"transaction","cluster":"c","slot":1,"index":1},"payload":1}', "invalid JSON"), (tx(1, " "), "invalid identity: signature"), (tx(1, "\\u3000"), "invalid identity: signature"), (tx("1.0"), "invalid JSON"), (tx(2**64 - 1), None)])
def test_line_errors(spark, line, error):
    assert parse_lines(spark.createDataFrame([(line,)], "value string")).first()["parse_error"] == error


def test_replay_file(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_bytes((tx(1) + "\r\n" + tx(2)).encode())
    assert [r["slot"] for r in read_jsonl(spark, str(good)).orderBy("ordinal").collect()] == [1, 2]
    bad = tmp_path / "b.jsonl"
    bad.write_text(tx(1) + "\n   \nnope\n")
    with pytest.raises(ReplayError) as e:
        read_jsonl(spark, str(bad))
    assert e.value.line_number == 2
    assert read_jsonl(spark, str(bad), "skip").count() == 1


def test_replay_twice(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, [tx(1, "a"), tx(2, "b", 1), tx(2, "b", 1)])
    first = pipeline.replay(tables, rows, "one")
    assert (first.events_seen, first.events_inserted, first.events_deduplicated, first.last_persisted_slot) == (3, 2, 1, 2)
    again = pipeline.replay(tables, rows, "two")
    assert (again.events_inserted, again.events_deduplicated) == (0, 3)
    resumed = pipeline.replay(tables, rows, "one")
    assert (resumed.resume_skipped, resumed.events_attempted, resumed.last_persisted_slot) == (3, 0, 2)
    service = Service(tables, "one")
    assert service.stream_lag("one")[1]["last_persisted_slot"] == 2
    assert service.stream_lag("none")[1] == {"stream_name": "none", "last_persisted_slot": 0, "last_contiguous_finalized_slot": None, "last_finalized_slot": None}
    assert len(service.recent_events()[1]) == 2


def test_first_write_wins_and_retry_is_idempotent(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    rows = events(spark, [tx(1, "a", payload="1"), tx(1, "a", payload="2")])
    for _ in range(2):
        pipeline.commit(tables, rows, "s", 0)
    assert [r["payload"] for r in tables.read("events").collect()] == ["1"]


def test_too_large_slots_are_skipped(spark):
    from tidemark.functions.identity import event_rows
    from tidemark.operators import dedup

    rows = event_rows(events(spark, [tx(1), tx(2**64 - 1)]))
    assert dedup.write_summary(rows).first().asDict() == {"attempted": 1, "inserted": 1, "deduplicated": 0, "skipped": 1}
    lost = event_rows(events(spark, [tx(2**64 - 1), tx(2**64 - 2)]))
    assert dedup.write_summary(lost).first().asDict() == {"attempted": 2, "inserted": 0, "deduplicated": 0, "skipped": 2}


def test_batches_of_two(spark):
    rows = spark.createDataFrame([(i, i + 1) for i in range(5)], "ordinal long, slot long")
    got = [(r["n_events"], r["cursor"]) for r in pipeline.logical_batches(rows, 2).orderBy("batch_no").collect()]
    assert got == [(2, 2), (2, 4), (1, 5)]
    assert [r["n_events"] for r in pipeline.logical_batches(pipeline.resume(rows, 2), 2).orderBy("batch_no").collect()] == [2, 1]


def states(spark, links):
    return spark.createDataFrame([("s", s, p, True, False) for s, p in links], "stream_name string, slot long, parent_slot long, finalized boolean, dead boolean")


@pytest.mark.parametrize("links,anchor,want", [
    ([(10, 9), (11, 10), (12, 11)], 10, 12), ([(10, 9), (12, 10), (15, 12)], 10, 15), ([(10, 9), (11, 10), (13, 12), (14, 13)], 10, 11), ([(10, 9), (12, 11)], 10, 10),
    ([(5, 4)], 20, 20), ([(7, 6), (8, 7), (9, 8)], None, 9), ([(10, 9), (11, 10), (12, 10), (13, 12)], 10, 13), ([(0, 0), (1, 0)], None, 1),
])
def test_frontier(spark, links, anchor, want):
    anchors = None if anchor is None else spark.createDataFrame([("s", anchor)], "stream_name string, anchor long")
    assert slots.finalized_frontier(states(spark, links), anchors).first()["contiguous"] == want


@pytest.mark.parametrize("links,anchor", [([(10, 9), (11, 10), (13, 12), (14, 13)], 10), ([(5, 4)], 20), ([(21, 20), (22, 21), (24, 22)], 20), ([(7, 6), (8, 7)], None), ([(9, 8), (10, 9), (12, 10), (12, 10)], 9)])
def test_long_streams_go_by_joins(spark, tmp_path, links, anchor):
    saved = lambda df: spark.createDataFrame(df.collect(), df.schema)
    anchors = None if anchor is None else spark.createDataFrame([("s", anchor)], "stream_name string, anchor long")
    shown = lambda df: sorted(map(tuple, df.select("stream_name", "contiguous", "head").collect()))
    assert shown(slots.finalized_frontier(states(spark, links), anchors, saved)) == shown(slots.finalized_frontier_doubling(states(spark, links), saved, anchors))


@pytest.mark.parametrize("per_bucket", [1, 4, 16])
def test_contracted_chains_equal_a_walk(spark, monkeypatch, per_bucket):
    """Random forests with gaps, forks, missing parents and anchors, over many small buckets."""
    monkeypatch.setattr(slots, "SLOTS_PER_BUCKET", per_bucket)
    r, rows, anchors, want = random.Random(per_bucket), [], [], {}
    for stream in range(8):
        known = {r.randrange(5): None}
        for s in range(max(known) + 1, 90):
            if r.random() < 0.85:
                known[s] = r.choice([*known][-3:]) if r.random() < 0.93 else r.choice([s, s + 3, 95, None])
        name = f"s{stream}"
        rows += [(name, s, p, r.random() < 0.97, False) for s, p in known.items()]
        final = {s: p for n, s, p, f, _ in rows if n == name and f}
        seed = min(final)
        if stream % 2:
            seed = r.randrange(100)
            anchors.append((name, seed))
        reached = {seed}
        for s in sorted(final):
            if s > seed and final[s] in reached and final[s] < s:
                reached.add(s)
        want[name] = (max(reached), max(final))
    df = spark.createDataFrame(rows, "stream_name string, slot long, parent_slot long, finalized boolean, dead boolean")
    got = slots.finalized_frontier(df, spark.createDataFrame(anchors, "stream_name string, anchor long")).collect()
    assert {x["stream_name"]: (x["contiguous"], x["head"]) for x in got} == want


def test_a_prefix_scan_in_blocks_equals_a_running_sum(spark):
    r = random.Random(8)
    data = [(i * 3, r.randrange(-50, 50)) for i in range(200)]
    df = spark.createDataFrame(data, "at long, value long").repartition(5)
    for inclusive in (False, True):
        got = {x["at"]: (x["a"], x["b"]) for x in pipeline.scanned(pipeline.scanned(df, "at", "value", F.sum, "a", inclusive, 7), "at", "value", F.max, "b", inclusive, 5, 3).collect()}
        for k, (at, _) in enumerate(data):
            before = [v for _, v in data[: k + inclusive]]
            assert got[at] == ((sum(before), max(before)) if before else (None, None))


def test_frontier_of_nothing(spark):
    assert slots.finalized_frontier(states(spark, []).where("slot > 0")).count() == 0


def test_frontier_variants_agree_on_random_forests(spark):
    r = random.Random(4)
    rows = []
    for stream in range(6):
        known = [r.randrange(5)]
        rows.append((f"s{stream}", known[0], None, True, False))
        for s in range(known[0] + 1, 60):
            if r.random() < 0.7:
                rows.append((f"s{stream}", s, r.choice(known[-4:]) + (r.random() < 0.1), r.random() < 0.9, r.random() < 0.1))
                known.append(s)
    df = spark.createDataFrame(rows, "stream_name string, slot long, parent_slot long, finalized boolean, dead boolean")
    want = {}
    for name in {x[0] for x in rows}:
        own = {x[1]: x[2] for x in rows if x[0] == name and x[3]}
        seed = min(own)
        reach = {seed}
        for s in sorted(own):
            if s != seed and own[s] is not None and own[s] < s and own[s] in reach:
                reach.add(s)
        want[name] = max(reach)
    assert {x["stream_name"]: x["contiguous"] for x in slots.finalized_frontier(df).collect()} == want
    assert {x["stream_name"]: x["contiguous"] for x in slots.finalized_frontier_doubling(df).collect()} == want
    assert slots.advance_min_child({10: [11, 12], 12: [13]}, 10) == 11


def slot_event(slot, parent, status="finalized"):
    return f'{{"identity":{{"kind":"slot","cluster":"c","slot":{slot},"status":"{status}"}},"payload":{{"parent":{parent}}}}}'


def test_gap_holds_and_fills(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    first = pipeline.replay(tables, events(spark, [slot_event(100, 99), slot_event(101, 100), slot_event(103, 102)]), "g", False, True)
    assert (first.last_persisted_slot, first.last_contiguous_finalized_slot, first.last_finalized_slot) == (103, 101, 103)
    filled = pipeline.replay(tables, events(spark, [slot_event(102, 101)]), "g", False, True)
    assert (filled.last_contiguous_finalized_slot, filled.last_finalized_slot) == (103, 103)
    late = pipeline.replay(tables, events(spark, [slot_event(5, 4)]), "g", False, True)
    assert late.last_contiguous_finalized_slot == 103
    lag = api.stream_lag(tables.read("stream_cursors"), "g").first()
    assert lag["last_persisted_slot"] == 103


def balances(*legs):
    return '{"token_balances":[' + ",".join(f'{{"account":"a{i}","mint":"{m}","pre":{a},"post":{b}}}' for i, (m, a, b) in enumerate(legs)) + "]}"


@pytest.mark.parametrize("payload,reason", [
    (balances(("a", 1000, 900), ("b", 500, 600)), None), (balances(("a", 1000, 900), ("b", 500, 600), ("c", 100, 200)), "leg_count"), (balances(("a", 100, 90), ("a", 50, 60)), "same_mint"),
    (balances(("a", 100, 0), ("b", 0, 250)), None), (balances(("a", 1, 2), ("b", 1, 2)), "sign"), (balances(("a", -(2**63), 2**63 - 1), ("b", 1, 2)), "sign"),
])
def test_swaps(spark, payload, reason):
    df = spark.createDataFrame([("e", payload)], "event_id string, payload string")
    row = decode.infer_swaps(decode.balance_deltas(df, "event_id"), "event_id").first()
    assert row["reason"] == reason
    if payload == balances(("a", 1000, 900), ("b", 500, 600)):
        assert (row["token_in"], row["token_in_amount"], row["token_out"], row["token_out_amount"]) == ("a", 100, "b", 100)


@pytest.mark.parametrize("payload,error", [("{}", "missing token_balances"), (balances(("a", "1000.0", 1)), "invalid pre"), (balances(("a", 1, '"1"')), "invalid post"), ('{"token_balances":[]}', None)])
def test_balance_errors(spark, payload, error):
    assert decode.with_balances(spark.createDataFrame([(payload,)], "payload string")).first()["decode_error"] == error


def update(program_index=1):
    ins = {"program_id_index": program_index, "accounts": bytes([0, 255]), "data": b"\0\1"}
    t = {"signature": b"sig", "is_vote": False, "index": Decimal(3), "message": {"account_keys": [b"k0", b"k1"], "instructions": [ins]}, "meta": {"inner_instructions": [{"index": 0, "instructions": [ins | {"program_id_index": 0}]}], "loaded_writable_addresses": [], "loaded_readonly_addresses": None}}
    return (["f"], "transaction", None, None, {"slot": Decimal(9), "transaction": t}, None, None)


def test_nested_transaction(spark):
    rows = normalize.normalize_updates(spark.createDataFrame([update()], UPDATE), "c").collect()
    assert sorted(r["kind"] for r in rows) == ["instruction", "instruction", "transaction"]
    assert all(r["error"] is None for r in rows)
    assert {r["program_id"] for r in rows} == {None, encode(b"k0"), encode(b"k1")}
    outer = next(r for r in rows if r["kind"] == "instruction" and r["inner_instruction_index"] is None)
    assert '"accounts":[0,255]' in outer["payload"]


def test_bad_index_spoils_the_transaction(spark):
    rows = normalize.normalize_updates(spark.createDataFrame([update(9)], UPDATE), "c").collect()
    assert [(r["kind"], r["error"]) for r in rows] == [("transaction", "program id index out of range")]


def test_silent_and_unknown_updates(spark):
    slot = lambda status: (None, "slot", None, {"slot": Decimal(5), "parent": Decimal(4), "status": status, "dead_error": None}, None, None, None)
    rows = [(None, "ping", None, None, None, None, None), (None, None, None, None, None, None, None), slot(3), slot(2), slot(77)]
    got = sorted((r["kind"], r["error"] or "") for r in normalize.normalize_updates(spark.createDataFrame(rows, UPDATE), "c").collect())
    assert got == [("slot", ""), ("slot", "unknown slot status: 77"), ("slot", "unsupported slot status: 3"), ("unknown", "missing update")]


def test_base58():
    assert encode(b"\0\0\1") == "112"
    assert encode(b"hello world") == "StV1DL6CwTryKyV"


def test_backoff_and_loop():
    rule = Backoff(1000, 30_000).normalized()
    assert rule.following(20_000) == 30_000
    assert 2000 <= rule.following(1000) <= 3000
    assert Backoff(0, 0, 0).normalized() == Backoff(1, 1, 1)
    slept, calls = [], []

    def attempt(n):
        calls.append(n)
        raise SourceError("receive" if len(calls) < 3 else "config")

    with pytest.raises(SourceError):
        reconnect_loop(attempt, Backoff(10, 100), slept.append, lambda: 0, jitter=lambda d: 0)
    assert (calls, slept) == ([0, 1, 2], [20, 40])
    with pytest.raises(SourceError):
        reconnect_loop(lambda n: (_ for _ in ()).throw(SourceError("connect")), Backoff(10, 100, max_attempts=2), slept.append, lambda: 0)
    assert not retryable(SourceError("subscribe", code="unauthenticated"))


def test_gap_risk_is_sticky():
    s = LiveStatus()
    s.reconnecting(1, 10, None, SourceError("connect"))
    s.running()
    assert (s.recovery_state, s.producer_state, s.gap_risk_count) == ("gap_risk", "running", 1)
    s.reconnecting(2, 10, 5, SourceError("connect"))
    s.running()
    assert s.recovery_state == "steady"
    s.observed(9, 1000)
    snap = s.snapshot(3500, 4)
    assert (snap["seconds_since_last_event"], snap["observed_to_persisted_slot_lag"]) == (2, 5)


def test_config():
    c = Config.from_env({"LIVE_ACCOUNT_INCLUDE": "include-1, include-2, include-1", "LIVE_TOKEN": "secret", "LIVE_SUBSCRIPTIONS": "slots,transactions"})
    assert c.account_include == ("include-1", "include-2")
    assert "secret" not in repr(c)
    with pytest.raises(ConfigError):
        csv_list("x", "one,,two")
    for env in ({"RUN_MODE": "live"}, {"STREAM_BATCH_SIZE": "0"}, {"LIVE_RECONNECT_MAX_DELAY_MS": "1"}, {"STREAM_NAME": " "}, {"LIVE_SUBSCRIPTIONS": "slots,accounts"}):
        with pytest.raises(ConfigError):
            Config.from_env(env)
    assert Config().with_args(["--replay", "x.jsonl", "--batch-size", "7"]).batch_size == 7


def test_subscription():
    r = Subscription(("slots", "transactions"), account_include=("a",)).with_from_slot(7).request()
    assert r["transactions"]["vote"] is False and r["slots"]["filter_by_commitment"] is False and r["from_slot"] == 7 and r["accounts"] == {}
    with pytest.raises(ValueError):
        Subscription(("slots",), account_include=("a",))


def test_metrics():
    m = Metrics()
    m.channel('a"\n\\', 1, 0)
    m.slots(5, 9)
    m.add("ingest_events_total", 2, "replay", "slot")
    m.observe_latency("w", 0.003)
    text = m.render()
    assert 'channel_utilization_ratio{stream_name="a\\"\\n\\\\"} 0' in text
    assert "slot_lag 0" in text and 'le="0.004"} 1' in text and 'le="0.002"} 0' in text
    assert len([x for x in text.splitlines() if x.startswith("# TYPE")]) == 11


def test_limits():
    assert [api.clamp(n) for n in (0, -5, 5000, None)] == [1, 1, 1000, 100]


def test_service(spark, tmp_path):
    service = Service(Tables(spark, str(tmp_path / "t")), "s", live=LiveStatus())
    assert service.health() == (200, "ok") and service.ready() == (200, {"ready": True})
    assert set(service.status()[1]) >= {"mode", "events_seen", "live", "last_finalized_slot"}
    assert service.recent_swaps()[1] == []


def test_stream_survives_a_crash(spark, tmp_path):
    """A batch that fails after its rows were written is replayed into the same tables."""
    from tidemark.plans.driver_queries import QUERIES  # noqa: F401
    from tidemark.streaming.ingest import Ingest

    rows = events(spark, [tx(1 + i // 4, f"s{i % 9}", i % 9) for i in range(40)])
    for part in range(2):
        rows.where(F.col("ordinal") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "drop"))
    tables = Tables(spark, str(tmp_path / "t"))
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "drop"))
    broken = Ingest(tables, "s")
    write = broken.write

    def crash(df, batch_id):
        write(df, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost")

    broken.write = crash
    with pytest.raises(Exception, match="lost"):
        broken.run(stream(), str(tmp_path / "ck"))
    Ingest(tables, "s").run(stream(), str(tmp_path / "ck"))
    want = rows.select(event_id().alias("i")).distinct().count()
    got = tables.read("events")
    assert got.count() == want == got.select("event_id").distinct().count()


def test_live_source(spark, tmp_path):
    TRANSPORTS["fixed"] = lambda request, start: iter([tx(i, f"s{i}") for i in range(1, 6)][start:])
    reader = LiveSource({"transport": "fixed", "max_per_batch": "3"}).streamReader(None)
    end = reader.latestOffset()
    assert end == {"position": 3}
    part = reader.partitions({"position": 0}, end)[0]
    assert [p for p, _ in reader.read(part)] == [0, 1, 2]
    reader.commit(end)
    again = LiveSource({"transport": "fixed", "max_per_batch": "3"}).streamReader(None)
    assert len(again.partitions({"position": 1}, {"position": 4})[0].lines) == 3


def test_stream_lag_of_many_streams(spark, tmp_path):
    import duckdb

    from tidemark.plans import driver_queries

    rows = [(i, f"stream-{i % 150}" if i % 151 else None, "F" if i % 3 else "O") for i in range(600)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    got = [tuple(x) for x in driver_queries.stream_lag(spark, str(tmp_path)).collect()]
    assert len(got) == 152 and sorted(got, key=str) == sorted(con.execute(driver_queries.ORACLES["stream_lag"]).fetchall(), key=str)
