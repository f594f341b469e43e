"""The command: replay a file or follow a live source, serve status, and end with a code that tells what failed."""

from __future__ import annotations

import hashlib
import os
import signal
import sys
import threading
import time
import uuid
from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession

from . import serve
from .config import EXIT_CODES, Config, ConfigError
from .metrics import Metrics
from .plans import pipeline
from .plans.commits import now_ms
from .plans.tables import Tables
from .sources.live import TRANSPORTS, Subscription
from .sources.replay import Parsed, ReplaySourceError
from .status import Service
from .streaming.feed import updates
from .streaming.ingest import Ingest
from .streaming.live import LiveLoop, file_transport
from .streaming.recovery import Backoff, LiveStatus, SourceError

TRANSPORTS.setdefault("file", file_transport)


class App:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.tables, self.metrics, self.stopped = Tables(spark, config.storage_root), Metrics(), threading.Event()
        self.live = LiveStatus() if config.run_mode == "live" else None
        self.service = Service(self.tables, config.stream_name, config.run_mode, self.metrics, self.live)
        self.loop: LiveLoop | None = None
        self.waiting = 0

    def stop(self, *_) -> None:
        self.stopped.set()
        if self.loop:
            self.loop.stop()

    def run(self) -> int:
        """The exit code."""
        c = self.config
        try:
            server = serve.start(self.service, c.http_addr, lambda: int(time.time() * 1000))
        except (OSError, ValueError) as e:
            return self._failed("http", e)
        run_id = uuid.uuid4().hex
        self._log_run(run_id, "running")
        code = EXIT_CODES["pipeline"]
        try:
            code = self._replay() if c.run_mode == "replay" else self._follow()
            if code == 0 and c.run_mode == "replay" and not c.exit_after_replay:
                self.stopped.wait()  # goes on serving
        finally:
            self._log_run(run_id, "completed" if code == 0 else "failed")
            server.shutdown()
        return code

    def _replay(self) -> int:
        c = self.config
        try:
            pipeline.replay_file(self.tables, c.replay_path, c.stream_name, on_parsed=self._parsed, batch_size=c.batch_size, on_progress=self._progress, stop=self.stopped.is_set)
        except ReplaySourceError as e:
            return self._failed("replay", e)
        except Exception as e:
            return self._failed("pipeline", e)
        return 0

    def _parsed(self, parsed: Parsed) -> None:
        for kind, n in parsed.kinds.items():
            self.metrics.add("ingest_events_total", n, "replay", kind)
        self.metrics.slots(parsed.last_slot or 0, 0)
        self.waiting = parsed.lines - parsed.bad

    def _files(self) -> int:
        """Follow a folder of files of updates, which executors read."""
        c = self.config
        sink = Ingest(self.tables, c.stream_name, on_progress=self._progress, metrics=self.metrics, batch_size=c.batch_size, cluster=c.cluster, status=self.live)
        try:
            query = sink.start(updates(self.spark, c.endpoint), f"{self.tables.root}/_checkpoints/{c.stream_name}", available_now=False)
            while not self.stopped.is_set():
                if query.awaitTermination(1):
                    return 0
            query.processAllAvailable()  # what has arrived is written first
            query.stop()
        except StreamingQueryException as e:
            return self._failed("pipeline", e)
        finally:
            sink.close()
        return 0

    def _follow(self) -> int:
        c = self.config
        if c.transport == "files":
            return self._files()
        request = Subscription(c.subscriptions, "processed", None, c.account_include, c.account_exclude, c.account_required)
        self.loop = LiveLoop(
            self.tables, c.stream_name, request, c.transport, c.cluster, c.batch_size, c.channel_capacity, metrics=self.metrics, status=self.live, on_progress=self._progress,
            backoff=Backoff(c.reconnect_initial_ms, c.reconnect_max_ms, c.reconnect_reset_ms, c.reconnect_max_attempts), stopped=self.stopped, options={"path": c.endpoint, "token": c.token},
        )
        if c.transport not in TRANSPORTS:
            return self._failed("live_not_built", ValueError(f"no transport named {c.transport}"))
        try:
            self.loop.run()
        except SourceError as e:
            return self._failed("live", e)
        except Exception as e:
            return self._failed("pipeline", e)
        return 0

    def _progress(self, summary: pipeline.Summary) -> None:
        self.service.update(summary)
        self.metrics.progress(summary)
        if self.config.run_mode == "replay":  # what is parsed and not yet written waits, as far as the channel goes
            self.metrics.channel(self.config.stream_name, max(0, min(self.waiting - summary.events_seen, self.config.channel_capacity)), self.config.channel_capacity)
        if summary.write_seconds_last and self.config.run_mode == "replay":
            self.metrics.observe_latency("events", summary.write_seconds_last)

    def _failed(self, what: str, error: Exception) -> int:
        print(f"{what}: {error}", file=sys.stderr)
        return EXIT_CODES[what]

    def _log_run(self, run_id: str, status: str) -> None:
        """One row for each run, updated at its end."""
        told = {"status": status, "config_hash": hashlib.sha256(repr(self.config).encode()).hexdigest()}
        self.tables.log_run(run_id, **told, **{"started_at" if status == "running" else "stopped_at": now_ms()})


def main(argv: list[str] | None = None, env: Mapping[str, str] | None = None, spark: SparkSession | None = None) -> int:
    try:
        config = Config.from_env(os.environ if env is None else env).with_args(sys.argv[1:] if argv is None else argv)
    except ConfigError as e:
        print(f"config: {e}", file=sys.stderr)
        return EXIT_CODES["config"]
    spark = spark or SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        app = App(spark, config)
    except Exception as e:
        print(f"storage: {e}", file=sys.stderr)
        return EXIT_CODES["storage"]
    if threading.current_thread() is threading.main_thread():
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, app.stop)
    return app.run()
