"""Files parsed once: numbers of lines over splits and files, dead letters, and the figures of a replay."""

import pytest
from test_ingest import LiveLoop, Subscription, slot_update, tx

from tidemark import app
from tidemark.plans import pipeline
from tidemark.plans.tables import Tables
from tidemark.sources.live import TRANSPORTS
from tidemark.sources.replay import ReplayError, ReplaySourceError, parse_once, read_jsonl
from tidemark.streaming.recovery import Backoff, SourceError


def saved(path):
    def cut(df):
        df.write.parquet(str(path))
        return df.sparkSession.read.schema(df.schema).parquet(str(path))

    return cut


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path, monkeypatch):
    """Small splits of several files, of which a task reads some together, largest first."""
    (tmp_path / "in").mkdir()
    want = []
    for f, n in (("a", 40), ("b", 3), ("c", 75), ("d", 1), ("e", 0)):
        lines = [tx(100 * ord(f) + i, f"{f}{i}") if i % 7 else ("x" * 300 if i % 2 else "") for i in range(n)]
        (tmp_path / "in" / f).write_text("\n".join(lines) + ("\n" if f != "c" and n else ""))
        want += [(f, i + 1, None if i % 7 == 0 else 100 * ord(f) + i) for i in range(n)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, ("700", "10"), strict=True):
            spark.conf.set(k, v)
        parsed = parse_once(spark, str(tmp_path / "in"), saved(tmp_path / "out"))
        got = [(r["source"][-1], r["line_number"], None if r["parse_error"] else int(r["slot"])) for r in parsed.rows.orderBy("ordinal").collect()]
        assert got == want and [r["ordinal"] for r in parsed.rows.orderBy("ordinal").collect()] == [*range(len(want))]
        assert parsed.rows.select("source", "line_number").distinct().count() == len(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    bad = sum(s is None for *_, s in want)
    assert (parsed.lines, parsed.bad, parsed.kinds, parsed.last_slot) == (len(want), bad, {"transaction": len(want) - bad}, 9974)
    with pytest.raises(ReplayError) as e:
        parsed.check()
    assert (e.value.line_number, e.value.reason) == (1, "empty line")


def test_a_replay_reads_its_source_once(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(tx(i, f"s{i}") for i in range(9)))
    tables = Tables(spark, str(tmp_path / "t"))
    done = pipeline.replay_file(tables, str(path), "s", on_parsed=lambda p: path.unlink(), batch_size=2, commit_rows=4)
    assert (done.events_inserted, done.batches_written, tables.read("events").count()) == (9, 5, 9)
    assert not list((tmp_path / "t/_scratch").glob("*"))
    with pytest.raises(ReplaySourceError):
        pipeline.replay_file(tables, str(path), "s")


def test_bad_lines_are_put_aside_with_reason_and_place(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\r\n".join([tx(1), "nope", tx(2), "  ", tx(3, " ")]) + "\r\n")
    tables = Tables(spark, str(tmp_path / "t"))
    with pytest.raises(ReplayError) as e:
        pipeline.replay_file(tables, str(path), "s")
    assert e.value.line_number == 2 and tables.read("events").count() == 0 and tables.read("dead_letters").count() == 0
    for k in range(2):
        done = pipeline.replay_file(tables, str(path), "s", "divert", use_resume=False)
        assert (done.events_seen, done.events_inserted) == (2, 2 if not k else 0)
    got = sorted((r["line_number"], r["reason"], r["line"]) for r in tables.read("dead_letters").collect())
    assert got == [(2, "invalid JSON", "nope\r"), (4, "empty line", "  \r"), (5, "invalid identity: signature", tx(3, " ") + "\r")]
    assert pipeline.replay_file(tables, str(path), "other", "skip").events_deduplicated == 2 and tables.read("dead_letters").count() == 3
    with pytest.raises(ValueError, match="no such way"):
        pipeline.replay_file(tables, str(path), "s", "drop")


def test_an_empty_file(spark, tmp_path):
    (tmp_path / "e").write_text("")
    tables = Tables(spark, str(tmp_path / "t"))
    assert pipeline.replay_file(tables, str(tmp_path / "e"), "s").events_seen == 0
    assert read_jsonl(spark, str(tmp_path / "e")).count() == 0


def test_bad_updates_of_a_live_source_can_be_read_back(spark, tmp_path):
    def feed(request, start):
        yield from [slot_update(5, 4), "broken", slot_update(6, 5, 77), slot_update(7, 5)]
        raise SourceError("subscribe", "no", "unauthenticated")

    TRANSPORTS["spoiled"] = feed
    tables = Tables(spark, str(tmp_path / "t"))
    loop = LiveLoop(tables, "s", Subscription(), "spoiled", linger_ms=50, backoff=Backoff(1, 1))
    with pytest.raises(SourceError):
        loop.run()
    got = sorted((r["stream_name"], r["source"], r["reason"], r["line"]) for r in tables.read("dead_letters").collect())
    assert got == sorted([("s", "spoiled", "missing update", "broken"), ("s", "spoiled", "unknown slot status: 77", slot_update(6, 5, 77))])
    assert loop.totals.events_inserted == 2 and loop.status.decode_errors_total == 2


def test_a_replay_sets_the_figures_of_its_channel(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(tx(i, f"s{i}") for i in range(5)))
    config = app.Config.from_env({"STORAGE_ROOT": str(tmp_path / "t")}).with_args(["--replay", str(path), "--exit-after-replay"])
    one = app.App(spark, config)
    depths = []
    channel = one.metrics.channel
    one.metrics.channel = lambda stream, depth, capacity: depths.append(depth) or channel(stream, depth, capacity)
    assert one._replay() == 0
    text = one.metrics.render()
    assert depths[0] == 5 and depths[-1] == 0 and 'channel_depth{stream_name="' in text and "ingest_events_total" in text
