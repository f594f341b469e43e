"""Updates from files by executors, and the figures of a running query."""

import threading
import time
from types import SimpleNamespace as N

from test_ingest import slot_update, transaction_update

from tidemark import app
from tidemark.metrics import Metrics
from tidemark.plans.tables import Tables
from tidemark.streaming.feed import Watch, updates
from tidemark.streaming.ingest import Ingest
from tidemark.streaming.recovery import LiveStatus


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(lines) + "\n")
    (folder / f".{name}").rename(folder / name)


def test_files_of_updates_are_ingested_once_and_watched(spark, tmp_path):
    feed, tables = tmp_path / "feed", Tables(spark, str(tmp_path / "t"))
    drop(feed, "a", slot_update(10, 9), slot_update(11, 10), "broken", transaction_update(11))
    drop(feed, "b", slot_update(11, 10), slot_update(12, 11), "")
    metrics, status = Metrics(), LiveStatus()
    sink = Ingest(tables, "f", metrics=metrics, cluster="c", status=status)
    done = sink.run(updates(spark, str(feed), 1), str(tmp_path / "ck"))  # a batch for each file
    assert (done.events_seen, done.events_inserted, done.events_deduplicated, done.last_contiguous_finalized_slot) == (6, 5, 1, 12)
    letters = tables.read("dead_letters").collect()
    assert [(r["reason"], r["line"], r["source"]) for r in letters] == [("missing update", "broken", "files")]
    deadline = time.time() + 30
    while time.time() < deadline and status.producer_state != "stopped" and "trigger" not in metrics.render():
        time.sleep(0.2)
    text = metrics.render()
    assert 'ingest_events_total{source="live",event_type="slot"} 4' in text and "decode_errors_total 1" in text and 'batch_write_latency_seconds_count{writer="events"} 2' in text
    # Again from the checkpoint: nothing new; with a fresh one everything is known by its id.
    assert Ingest(tables, "f", cluster="c").run(updates(spark, str(feed)), str(tmp_path / "ck")).events_seen == 0
    again = Ingest(tables, "f", cluster="c").run(updates(spark, str(feed)), str(tmp_path / "ck2"))
    assert (again.events_inserted, tables.read("events").count()) == (0, 5)


def test_gauges_of_a_running_query(spark, tmp_path):
    feed, tables = tmp_path / "feed", Tables(spark, str(tmp_path / "t"))
    for k in range(4):
        drop(feed, f"f{k}", slot_update(10 + k, 9 + k))
    metrics, status = Metrics(), LiveStatus()
    sink = Ingest(tables, "watched", metrics=metrics, cluster="c", status=status)
    query = sink.start(updates(spark, str(feed), 1), str(tmp_path / "ck"), available_now=False, interval="0 seconds")
    try:
        deadline = time.time() + 90
        while time.time() < deadline and sink.totals.events_seen < 4:
            time.sleep(0.05)
        time.sleep(1)
        text = metrics.render()
        assert sink.totals.events_inserted == 4 and 'source_rows_per_second{stream_name="watched",side="processed"}' in text and 'batch_write_latency_seconds_count{writer="trigger"}' in text
        assert status.producer_state == "running" and status.last_observed_slot in range(10, 14)  # files of one instant come in any order
    finally:
        query.stop()
        deadline = time.time() + 20
        while time.time() < deadline and status.producer_state == "running":
            time.sleep(0.1)
        sink.close()
    assert status.producer_state == "stopped"


def test_the_command_follows_a_folder(spark, tmp_path):
    feed = tmp_path / "feed"
    drop(feed, "a", slot_update(3, 2))
    config = app.Config.from_env({"STORAGE_ROOT": str(tmp_path / "t"), "HTTP_ADDR": "127.0.0.1:0"}).with_args(["--live", "--transport", "files", "--endpoint", str(feed), "--stream-name", "files-l"])
    one = app.App(spark, config)
    codes = []
    thread = threading.Thread(target=lambda: codes.append(one.run()))
    thread.start()
    deadline = time.time() + 120
    while time.time() < deadline and not one.service.summary.events_inserted:
        time.sleep(0.2)
    one.stop()
    thread.join(60)
    assert codes == [0] and Tables(spark, str(tmp_path / "t")).read("events").count() == 1
    assert one.live.producer_state in ("running", "stopped")


def test_progress_becomes_figures():
    """Backlog is shown where the source reports it; other queries are left out; a failure is told."""
    metrics, status = Metrics(), LiveStatus()
    watch = Watch("q", metrics, status)
    watch.onQueryStarted(N(name="q", runId="1"))
    watch.onQueryStarted(N(name="other", runId="2"))
    source = N(metrics={"numFilesOutstanding": "3", "numBytesOutstanding": "70"}, inputRowsPerSecond=float("nan"), processedRowsPerSecond=2.5)
    for name in ("q", "other"):
        watch.onQueryProgress(N(progress=N(name=name, sources=[source], numInputRows=5, durationMs={"triggerExecution": 40})))
    text = metrics.render()
    assert 'source_backlog_files{stream_name="q"} 3' in text and 'source_backlog_bytes{stream_name="q"} 70' in text and "other" not in text
    assert 'side="arrived"} 0' in text and 'side="processed"} 2.5' in text and 'batch_write_latency_seconds_sum{writer="trigger"} 0.04' in text
    watch.onQueryTerminated(N(runId="2", exception="x"))
    assert status.producer_state == "running" and status.last_event_at_unix_ms
    watch.onQueryTerminated(N(runId="1", exception="lost\nmore"))
    assert (status.producer_state, status.last_error) == ("failed", "lost")
