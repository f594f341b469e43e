"""Batch ingestion: events, slot states and the cursor by one entry of the log, then the swaps and the frontier that follow from them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import asdict, dataclass, fields
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.identity import event_rows
from ..operators import decode, dedup, slots
from ..schema import MAX_LONG
from ..sources.replay import Parsed, parse_once
from .commits import Clash
from .tables import APPENDED, BY_VALUE, Tables, marks, overlaps

BATCH_SIZE = 500
#: Batches of so few rows are put into one partition, which saves their shuffles.
SMALL = 20_000
COMPACT_AT = 24  # small folders of a table that are put together
#: Rows of one commit of a replay. Logical batches of BATCH_SIZE only set the counters; a Spark job for each would be all overhead.
COMMIT_ROWS = 1_000_000
#: Numbers of the order in which one task counts rows, whatever the size of a batch.
RANGE = 32_000


@dataclass
class Summary:
    events_seen: int = 0
    events_skipped: int = 0
    resume_skipped: int = 0
    conversion_skipped: int = 0
    batches_written: int = 0
    events_attempted: int = 0
    events_inserted: int = 0
    events_deduplicated: int = 0
    swaps_written: int = 0
    last_persisted_slot: int | None = None
    last_contiguous_finalized_slot: int | None = None
    last_finalized_slot: int | None = None
    write_seconds_total: float = 0.0
    write_seconds_max: float = 0.0
    write_seconds_last: float = 0.0

    def add(self, more: Summary) -> None:
        """Counters add up, markers and the longest write grow, the last write is the newer one's."""
        for f in fields(self):
            old, new = getattr(self, f.name), getattr(more, f.name)
            if f.name.startswith("last_") or f.name == "write_seconds_max":
                new = old if new is None else new if old is None else max(old, new)
            elif f.name == "write_seconds_last":
                new = new or old
            else:
                new = old + new
            setattr(self, f.name, new)


Progress = Callable[[Summary], None]


def resume(rows: DataFrame, after: int | None) -> DataFrame:
    """Drop rows up to and with a slot. Kept on the plain column, so it reaches the scan."""
    return rows if after is None else rows.where(F.col("slot") > after)


def scanned(rows: DataFrame, at: str, value: str, of: Callable[[str], Column], name: str, inclusive: bool, block: int = 4096, levels: int = 1) -> DataFrame:
    """Add the running aggregate ``of`` (F.sum or F.max) of ``value`` in the order of the whole numbers ``at``; ``inclusive`` of the row's own.

    A blocked prefix scan: running values within blocks of numbers, the blocks' totals scanned alike, and what came before a block put on its
    rows. Only the totals of the last level stand in one task, a row for ``block`` to the power of ``levels`` numbers.
    """
    last = 0 if inclusive else -1
    if not levels:
        return rows.withColumn(name, of(value).over(Window.orderBy(at).rowsBetween(Window.unboundedPreceding, last)))
    number, inside, before, total = (f"_{x}{levels}" for x in ("block", "inside", "before", "total"))
    blocked = rows.withColumn(number, F.floor(F.col(at) / block))
    totals = scanned(blocked.groupBy(number).agg(of(value).alias(total)), number, total, of, before, False, block, levels - 1).drop(total)
    within = of(value).over(Window.partitionBy(number).orderBy(at).rowsBetween(Window.unboundedPreceding, last))
    both = blocked.withColumn(inside, within).join(totals, number)
    whole = F.greatest(inside, before) if of is F.max else F.coalesce(F.col(inside) + F.col(before), inside, before)
    return both.withColumn(name, whole).drop(number, inside, before)


def numbered(rows: DataFrame, size: int, order: str = "ordinal") -> DataFrame:
    """All columns and ``batch_no``: rows in arrival order cut by count.

    Two passes instead of one global sort: ranges of the order are counted, then each row's number is its range's start
    plus its place in the range. A range is as wide for large batches as for small ones, so no task holds more than its rows.
    """
    ranged = rows.withColumn("_r", F.floor(F.col(order) / RANGE))
    starts = scanned(ranged.groupBy("_r").agg(F.count("*").alias("_n")), "_r", "_n", F.sum, "_first", False).select("_r", F.coalesce("_first", F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_r").orderBy(order))
    return ranged.withColumn("_p", place).join(starts, "_r").withColumn("batch_no", F.floor((F.col("_first") + F.col("_p") - 1) / size).cast("long")).drop("_r", "_p", "_first")


def logical_batches(rows: DataFrame, size: int = BATCH_SIZE, order: str = "ordinal") -> DataFrame:
    """batch_no, n_events, max_slot, cursor: rows in arrival order cut by count, and the running maximum slot."""
    batches = numbered(rows.select(order, "slot"), size, order).groupBy("batch_no").agg(F.count("*").alias("n_events"), F.max("slot").alias("max_slot"))
    return scanned(batches, "batch_no", "max_slot", F.max, "cursor", True)


def commit(tables: Tables, rows: DataFrame, stream_name: str, batch: int | None = None, advance_frontier: bool = False, batch_size: int = BATCH_SIZE, writer: str | None = None, dead: DataFrame | None = None) -> Summary:
    """Write one batch of envelope rows (with ``ordinal``).

    Events, slot states and the cursor take effect together, by one entry of the log; swaps and the frontier follow from what is stored
    (see ``settle``), so a crash at any place leaves nothing that the next commit or run does not make good. A ``writer`` that numbers
    its batches gets the answer of the first time for one that it repeats. ``dead``: rows of dead letters that come with the batch.
    """
    began = time.monotonic()
    if writer is not None and batch is not None and (known := tables.state().writers.get(writer)) and batch <= known[0]:
        done = Summary(**known[1]) if batch == known[0] else Summary()
        done.add(settle(tables, stream_name, advance_frontier))
        return done
    rows = event_rows(rows, "ordinal", "kind", "status").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        told = rows.withColumn("_place", F.expr(f"monotonically_increasing_id() & {(1 << 33) - 1}")).agg(*_asked()).first()
        letters = {} if dead is None or not (part := tables.write("dead_letters", dead)) else {"dead_letters": {part[0]: part[1]}}
        if not told["n"]:
            if letters:
                tables.put({"add": letters})
            return settle(tables, stream_name, advance_frontier)
        top, bad = int(told["top"]), told["n"] - told["ok"]
        while True:
            seen = tables.state().version
            inserted, new = 0, {}
            if told["ok"] and (events := write_new(tables, rows, told)):
                inserted, new["events"] = events[1]["rows"], {events[0]: events[1] | {"balances": bool(told["balances"])}}
            if advance_frontier and told["marked"] and (states := write_states(tables, rows, stream_name, seen, told["n"] > SMALL)):
                new["stream_slots"] = {states[0]: states[1] | {"stream": stream_name}}
            done = Summary(told["n"], bad, 0, bad, -(-told["n"] // batch_size), told["ok"] or bad, inserted, told["ok"] - inserted, 0, top)
            entry: dict = {"add": new | letters}
            if top <= MAX_LONG:
                entry["cursors"] = {stream_name: marks(persisted=top)}
                if writer is not None and batch is not None:
                    entry["writers"] = {writer: [batch, asdict(done)]}
            try:
                tables.put(entry, lambda s: not any(p["v"] > seen and overlaps(p, int(told["low"]), int(told["high"] or 0)) for p in s.parts.get("events", {}).values()))
                break
            except Clash:  # others stored events of the same slots meanwhile, which may be the same events
                for name, parts in new.items():
                    for folder in parts:
                        tables.remove(name, folder)
        done.add(settle(tables, stream_name, advance_frontier))
        if top > MAX_LONG:
            raise ValueError("cursor slot exceeds the signed 64-bit range")
        done.write_seconds_total = done.write_seconds_max = done.write_seconds_last = time.monotonic() - began
        return done
    finally:
        rows.unpersist()


@cache
def _asked() -> tuple[Column, ...]:
    """What a commit asks about its batch before it writes."""
    fits = f"slot <= {MAX_LONG}BD"
    return tuple(
        F.expr(e)
        for e in (
            "count(1) AS n",
            "max(slot) AS top",
            f"count_if({fits}) AS ok",
            "min(slot) AS low",
            f"max(CASE WHEN {fits} THEN slot END) AS high",
            "bool_or(contains(payload, 'token_balances')) AS balances",
            f"count_if({fits} AND kind = 'slot' AND status IN ('finalized', 'dead')) AS marked",
            # The ids of a batch of up to BY_VALUE rows; of a larger one some, which are not used.
            f"slice(collect_set(CASE WHEN {fits} AND _place < {BY_VALUE} THEN event_id END), 1, {BY_VALUE}) AS ids",
        )
    )


def write_new(tables: Tables, rows: DataFrame, told: Row) -> tuple[str, dict] | None:
    """The first row of each event id that the tables don't hold, in a folder of its own.

    Stored ids are looked up in folders whose slots reach those of the batch: by value for a small batch, by a join that leaves the table
    where it is for one that fits a broadcast (its rows were counted), and by shuffles beyond.
    """
    fresh = dedup.convertible(rows if told["n"] > SMALL else rows.coalesce(1))
    fresh = dedup.first_wins(fresh.select(*[c for c in fresh.columns if c not in ("kind", "status")]))
    low, high, now = int(told["low"]), int(told["high"]), F.current_timestamp()
    add = lambda held: tables.write("events", (fresh if held is None else fresh.join(held, "event_id", "left_anti")).withColumn("observed_at", now).withColumn("inserted_at", now))
    if not tables.parts("events", low, high):
        return add(None)
    if told["n"] <= BY_VALUE:
        with tables.by_value():
            return add(F.broadcast(tables.known_ids(told["ids"], low, high)))
    held = tables.read("events", low, high).select("event_id")
    if told["n"] <= SMALL:
        held = F.broadcast(held.join(F.broadcast(fresh.select("event_id")), "event_id", "left_semi"))
    return add(held)


def write_states(tables: Tables, rows: DataFrame, stream_name: str, seen: int, many: bool = False) -> tuple[str, dict] | None:
    """The slot states of a batch, in a folder of their own; those of ``many`` rows are parsed and merged by all tasks."""
    new = slots.merge_states(slots.slot_states(dedup.convertible(rows if many else rows.coalesce(1))), order="ordinal")
    return tables.write("stream_slots", new.withColumn("stream_name", F.lit(stream_name)).withColumn("first_seen_at", F.current_timestamp()).withColumn("batch", F.lit(seen)))


def settle(tables: Tables, stream_name: str, advance_frontier: bool = True) -> Summary:
    """What follows from stored rows and is not stored yet: swaps of all undecoded events, and the stream's frontier."""
    done = Summary(swaps_written=decode_pending(tables))
    if advance_frontier:
        done.last_contiguous_finalized_slot, done.last_finalized_slot = advance(tables, stream_name)
    return done


def decode_pending(tables: Tables) -> int:
    """Swaps of the events stored since the last decoding, whoever stored them; how many.

    The swaps and the number up to which entries are decoded are one entry of the log: no event is decoded twice and none is left out.
    """
    while True:
        state = tables.state()
        decoded, upto = state.decoded, state.version
        pending = [k for k, p in state.parts.get("events", {}).items() if p.get("balances") and p["v"] > decoded]
        if not pending:
            return 0
        keys = ("event_id", "slot", "signature", "program_id")
        rows = tables.rows("events", pending).where(F.col("payload").contains("token_balances"))
        found = decode.swap_rows(decode.infer_swaps(decode.balance_deltas(rows, *keys), *keys), *keys).withColumn("inferred_at", F.current_timestamp())
        part = tables.write("swaps", found)
        try:
            tables.put({"decoded": upto, "add": {"swaps": {part[0]: part[1]}} if part else {}}, lambda s: s.decoded == decoded)  # noqa: B023
            return part[1]["rows"] if part else 0
        except Clash:
            if part:
                tables.remove("swaps", part[0])


def save_cursor(tables: Tables, stream_name: str, persisted: int | None, contiguous: int | None = None, finalized: int | None = None) -> None:
    """Raise a stream's markers; none goes back."""
    tables.save_cursor(stream_name, persisted, contiguous, finalized)


def advance(tables: Tables, stream_name: str) -> tuple[int | None, int | None]:
    """Walk the frontier on from its stored place over states that came since, and store it; it never goes back.

    Only folders with slots from the frontier on are read, and none if the stream has no new states. A frontier stays where no state names it as
    parent, however much is stored above the gap; that is asked of the states as they were written, which is cheaper than the walk.
    """
    state = tables.state()
    upto, cursor = state.version, state.cursors.get(stream_name, {})
    anchor, head = cursor.get("contiguous"), cursor.get("finalized")
    parts, walked = tables.parts("stream_slots", stream=stream_name), state.walked.get(stream_name, -1)
    if not any(p["v"] > walked for p in parts.values()):
        return anchor, head
    # A compacted folder is newer than the states in it, so its states count as new once more: none is left out.
    if anchor is not None:
        new = tables.rows("stream_slots", [k for k, p in parts.items() if p["v"] > walked]).where(F.col("stream_name") == stream_name)
        if tables.rows("stream_slots", [k for k, p in parts.items() if overlaps(p, anchor, None)]).where((F.col("stream_name") == stream_name) & (F.col("slot") > anchor) & (F.col("parent_slot") == anchor)).isEmpty():
            top = new.where("finalized").agg(F.max("slot")).first()[0]
            head = max((x for x in (top, head) if x is not None), default=None)
            tables.save_cursor(stream_name, None, None, head, walked={stream_name: upto})
            return anchor, head
    states = tables.read("stream_slots", anchor, stream=stream_name)
    anchors = tables.spark.createDataFrame([(stream_name, anchor)], "stream_name string, anchor long").where("anchor is not null")
    kept: list[DataFrame] = []
    with tables.scratch() as cut:
        found = slots.finalized_frontier(states, anchors, cut, lambda df: kept.append(df.persist()) or kept[-1]).first()
    for df in kept:
        df.unpersist()
    contiguous, top = (found["contiguous"], found["head"]) if found else (None, None)
    head = max((x for x in (top, head) if x is not None), default=None)
    tables.save_cursor(stream_name, None, contiguous, head, walked={stream_name: upto})
    return contiguous if found else anchor, head


def maintain(tables: Tables, every: int = COMPACT_AT) -> None:
    """Compact the tables that have ``every`` small folders or more."""
    for name in APPENDED:
        tables.compact(name, every)


def commits(tables: Tables, rows: DataFrame, n: int, size: int, stream_name: str, advance_frontier: bool, batch_size: int) -> Iterator[Summary]:
    """Commit the rows in arrival order, ``size`` at a time. More than one part is laid down first, so the source is read once.

    Small commits are prepared together, as many as have ``COMMIT_ROWS`` rows, so the number of Spark jobs grows with the rows and not with the commits.
    """
    if not n:
        return
    if n <= size:
        yield commit(tables, rows, stream_name, None, advance_frontier, batch_size)
        return
    several = max(1, COMMIT_ROWS // size)
    with tables.scratch("_group") as cut:
        laid = cut(numbered(rows, size).withColumn("_group", F.floor(F.col("batch_no") / several)))
        for g in range(-(-n // (size * several))):
            part = laid.where(F.col("_group") == g).drop("_group")
            if several == 1:
                yield commit(tables, part.drop("batch_no"), stream_name, None, advance_frontier, batch_size)
            else:
                yield from commit_together(tables, part, stream_name, advance_frontier, batch_size)


def commit_together(tables: Tables, rows: DataFrame, stream_name: str, advance_frontier: bool = False, batch_size: int = BATCH_SIZE) -> Iterator[Summary]:
    """Commits by ``batch_no``, in its order: the folders of all are written at once, then each takes effect by its own entry of the log.

    An event is new in the first commit that has it. Swaps and the frontier follow after the last commit (see ``settle``). Where another writer
    stores events of the same slots meanwhile, or a slot is too large, the commits that are left are made one by one.
    """
    began, left, new, states = time.monotonic(), [], {}, {}
    envelopes = event_rows(rows, "ordinal", "kind", "status", "batch_no").persist(StorageLevel.MEMORY_AND_DISK)
    one = lambda k: commit(tables, rows.where(F.col("batch_no") == k).drop("batch_no"), stream_name, None, advance_frontier, batch_size)
    try:
        seen = tables.state().version
        left = sorted(envelopes.groupBy("batch_no").agg(*_asked()[:-1]).collect(), key=lambda t: t["batch_no"])
        if any(t["ok"] < t["n"] for t in left):
            while left:
                yield one(left.pop(0)["batch_no"])
            return
        low, high = int(min(t["low"] for t in left)), int(max(t["high"] for t in left))
        new = tables.write_by("events", _fresh(tables, envelopes, low, high), "batch_no")
        if advance_frontier and any(t["marked"] for t in left):
            marked = slots.merge_states(slots.slot_states(dedup.convertible(envelopes), "batch_no"), "batch_no", order="ordinal")
            order = F.lit(seen) + F.col("batch_no") - F.lit(left[0]["batch_no"])
            states = tables.write_by("stream_slots", marked.withColumn("stream_name", F.lit(stream_name)).withColumn("first_seen_at", F.current_timestamp()).withColumn("batch", order), "batch_no")
        share, own = (time.monotonic() - began) / len(left), {folder for folder, _ in new.values()}
        while left:
            began, t = time.monotonic(), left[0]
            k, bottom, top = t["batch_no"], int(t["low"]), int(t["top"])
            entry: dict = {"add": {}, "cursors": {stream_name: marks(persisted=top)}}
            if k in new:
                entry["add"]["events"] = {new[k][0]: new[k][1] | {"balances": bool(t["balances"])}}
            if k in states:
                entry["add"]["stream_slots"] = {states[k][0]: states[k][1] | {"stream": stream_name}}
            try:
                tables.put(entry, lambda s: not any(p["v"] > seen and f not in own and overlaps(p, bottom, top) for f, p in s.parts.get("events", {}).items()))  # noqa: B023
            except Clash:
                break
            inserted = new.pop(k)[1]["rows"] if k in new else 0
            states.pop(k, None)
            left.pop(0)
            done = Summary(t["n"], 0, 0, 0, -(-t["n"] // batch_size), t["n"], inserted, t["n"] - inserted, 0, top)
            if not left:
                done.add(settle(tables, stream_name, advance_frontier))
            took = share + time.monotonic() - began
            done.write_seconds_total = done.write_seconds_max = done.write_seconds_last = took
            yield done
        _forget(tables, new, states)
        while left:
            yield one(left.pop(0)["batch_no"])
    finally:
        _forget(tables, new, states)
        envelopes.unpersist()


def _forget(tables: Tables, new: dict, states: dict) -> None:
    """Delete folders that no entry names."""
    for name, parts in (("events", new), ("stream_slots", states)):
        while parts:
            tables.remove(name, parts.popitem()[1][0])


def _fresh(tables: Tables, rows: DataFrame, low: int, high: int) -> DataFrame:
    """The first row of each event id that the tables don't hold, by a join with what they hold of these slots."""
    fresh = dedup.first_wins(dedup.convertible(rows).drop("kind", "status"))
    if tables.parts("events", low, high):
        fresh = fresh.join(tables.read("events", low, high).select("event_id"), "event_id", "left_anti")
    return fresh.withColumn("observed_at", F.current_timestamp()).withColumn("inserted_at", F.current_timestamp())


def replay(tables: Tables, rows: DataFrame, stream_name: str = "replay", use_resume: bool = True, advance_frontier: bool = False, batch_size: int = BATCH_SIZE, commit_rows: int = COMMIT_ROWS, on_progress: Progress | None = None, stop: Callable[[], bool] | None = None) -> Summary:
    """Ingest envelope rows after dropping what the stream's cursor has passed, in commits cut by count.

    ``on_progress`` is called before, after each commit and at the end. ``stop`` is asked between commits.
    """
    after = tables.state().cursors.get(stream_name, {}).get("persisted") if use_resume else None
    total = Summary(last_persisted_slot=after)
    tell = on_progress or (lambda _: None)
    tell(total)
    total.add(settle(tables, stream_name, advance_frontier))  # what a run that died has left
    left = resume(rows, after)
    n = left.count()
    if after is not None:
        total.resume_skipped = total.events_skipped = total.events_seen = rows.count() - n
    size = max(batch_size, commit_rows // batch_size * batch_size)
    made, every = 0, size * max(1, COMMIT_ROWS // size)  # compaction comes between groups of commits, never within one
    with closing(commits(tables, left, n, size, stream_name, advance_frontier, batch_size)) as under_way:
        for done in under_way:
            total.add(done)
            tell(total)
            made += done.events_seen
            if made >= min(n, every):
                made = 0
                maintain(tables)
            if stop and stop():
                total.add(settle(tables, stream_name, advance_frontier))
                break
    tell(total)
    return total


def replay_file(tables: Tables, path: str, stream_name: str = "replay", bad: str = "strict", on_parsed: Callable[[Parsed], None] | None = None, **how) -> Summary:
    """Replay a file or folder of JSON lines, each parsed once; ``how`` as for ``replay``.

    ``bad``: a bad line ends a "strict" replay before anything is stored (ReplayError); "divert" puts bad lines into the dead letters with their
    reason and place, once however often the source is replayed, and goes on; "skip" leaves them out.
    """
    if bad not in ("strict", "divert", "skip"):
        raise ValueError(f"no such way with bad lines: {bad}")
    with tables.scratch() as cut:
        parsed = parse_once(tables.spark, path, cut)
        if bad == "strict":
            parsed.check()
        if on_parsed:
            on_parsed(parsed)
        if bad == "divert" and parsed.bad:
            letters = parsed.rows.where("parse_error is not null").select(F.lit(stream_name).alias("stream_name"), "source", "line_number", F.col("parse_error").alias("reason"), "line", F.current_timestamp().alias("seen_at"))
            letters = letters.join(tables.read("dead_letters").where(F.col("stream_name") == stream_name).select("source", "line_number"), ["source", "line_number"], "left_anti")
            if part := tables.write("dead_letters", letters):
                tables.put({"add": {"dead_letters": {part[0]: part[1]}}})
        return replay(tables, parsed.good, stream_name, **how)
