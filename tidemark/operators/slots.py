"""Slot states, cursors and the contiguous finalized frontier."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strict_json as J
from ..schema import SLOTS_PER_BUCKET


def parent_slot() -> Column:
    """The parent named in a slot event's payload; null if it is none or too large."""
    parent = J.as_u64(J.at(J.parse(F.col("payload")), "$.parent"))
    return F.when(parent <= F.lit(2**63 - 1).cast("decimal(20,0)"), parent.cast("long"))


def slot_states(events: DataFrame, *keep: str) -> DataFrame:
    """slot, parent_slot, finalized, dead, ordinal (and ``keep``) of the finalized and dead slot events; other events are dropped."""
    rows = events.where((F.col("kind") == "slot") & F.col("status").isin("finalized", "dead"))
    return rows.select("slot", parent_slot().alias("parent_slot"), (F.col("status") == "finalized").alias("finalized"), (F.col("status") == "dead").alias("dead"), "ordinal", *keep)


def merge_states(states: DataFrame, *keys: str, order: str = "ordinal", also: dict[str, Column] | None = None) -> DataFrame:
    """One state for each slot: flags are or-ed, the parent is the last that is not null by ``order``. ``also``: further aggregates by name."""
    return states.groupBy(*keys, "slot").agg(
        F.max_by("parent_slot", F.when(F.col("parent_slot").isNotNull(), F.col(order))).alias("parent_slot"),
        F.bool_or("finalized").alias("finalized"),
        F.bool_or("dead").alias("dead"),
        *[c.alias(n) for n, c in (also or {}).items()],
    )


def upsert_states(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Old states with the batch's merged in: a new parent replaces an old one, flags are or-ed."""
    both = old.select(*keys, "slot", "parent_slot", "finalized", "dead", F.lit(0).alias("ordinal")).unionByName(new.select(*keys, "slot", "parent_slot", "finalized", "dead", F.lit(1).alias("ordinal")))
    return merge_states(both, *keys)


def _seeds(final: DataFrame, anchors: DataFrame | None) -> DataFrame:
    """stream_name, seed (the anchor, else the smallest finalized slot), head."""
    bounds = final.groupBy("stream_name").agg(F.min("slot").alias("least"), F.max("slot").alias("top"))
    seeds = bounds.withColumn("anchor", F.lit(None).cast("long")) if anchors is None else bounds.join(anchors.select("stream_name", F.col("anchor").cast("long")), "stream_name", "full")
    return seeds.select("stream_name", F.coalesce("anchor", "least").alias("seed"), F.coalesce("top", "anchor").alias("head"))


_CHAINS = "stream_name string, slot long, root long, open long, seed long"


def _contract(pdf: pd.DataFrame) -> pd.DataFrame:
    """Each slot of a bucket with the first slot of its chain within the bucket, and that one's parent below (-1: it leads nowhere)."""
    known = pdf.groupby("slot")["parent_slot"].max()
    slot, parent, seed = known.index.to_numpy(), known.to_numpy(), int(pdf["seed"].iloc[0])
    linked = (parent >= seed) & (parent < slot)
    at = np.minimum(np.searchsorted(slot, parent), len(slot) - 1)
    up = np.where(linked & (slot[at] == parent), at, np.arange(len(slot)))
    while (further := up[up]).tolist() != up.tolist():
        up = further
    return pd.DataFrame({"stream_name": pdf["stream_name"].iloc[0], "slot": slot, "root": slot[up], "open": np.where(linked[up], parent[up], -1), "seed": seed})


def finalized_frontier(states: DataFrame, anchors: DataFrame | None = None, cut: Callable[[DataFrame], DataFrame] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """stream_name, contiguous, head: how far proven ancestry reaches from the anchor (else the smallest finalized slot).

    Chains are contracted within buckets of slots first, whose groups hold ``SLOTS_PER_BUCKET`` slots at most; what is left of a bucket is
    a segment for each slot in it whose parent lies below it or is missing, as a rule one. Segments then point at the segment of their
    parent, and squaring these pointers leads each to the seed or nowhere in logarithmically many joins. A pointer that has arrived
    takes no part any more. Finalized counts even where the slot is also dead. Streams without anchor and finalized slot are absent.

    ``keep`` holds a frame that is used again (persist, if not given); ``cut`` also cuts its lineage (checkpoint), once for each such join.
    """
    keep, cut = keep or (lambda df: df.persist()), cut or (lambda df: df.checkpoint())
    final = states.where("finalized").select("stream_name", "slot", "parent_slot")
    seeds = keep(_seeds(final, anchors))
    above = final.join(seeds.select("stream_name", "seed"), "stream_name").where("slot > seed")
    bucket = F.floor(F.col("slot") / SLOTS_PER_BUCKET).alias("bucket")
    chains = keep(above.select("stream_name", "slot", F.coalesce("parent_slot", F.lit(-1)).alias("parent_slot"), "seed", bucket).groupBy("stream_name", "bucket").applyInPandas(_contract, _CHAINS))
    segments = chains.groupBy("stream_name", "root").agg(F.max("slot").alias("far"), F.max("open").alias("open"), F.max("seed").alias("seed"))
    known = chains.select("stream_name", F.col("slot").alias("open"), F.col("root").alias("up"))
    home = F.col("open") == F.col("seed")
    pointers = keep(segments.join(known, ["stream_name", "open"], "left").select("stream_name", "root", "far", F.col("up"), (home | F.col("up").isNull()).alias("done"), home.alias("reached")))
    while not (under_way := pointers.where("not done")).isEmpty():
        onward = pointers.select("stream_name", F.col("root").alias("up"), F.col("up").alias("next"), F.col("done").alias("there"), F.col("reached").alias("home"))
        moved = under_way.select("stream_name", "root", "far", "up").join(onward, ["stream_name", "up"]).select("stream_name", "root", "far", F.col("next").alias("up"), F.col("there").alias("done"), F.col("home").alias("reached"))
        pointers = cut(pointers.where("done").unionByName(moved))
    reached = pointers.where("reached").groupBy("stream_name").agg(F.max("far").alias("far"))
    return seeds.join(reached, "stream_name", "left").select("stream_name", F.coalesce("far", "seed").alias("contiguous"), "head")


def finalized_frontier_doubling(states: DataFrame, checkpoint=None, anchors: DataFrame | None = None) -> DataFrame:
    """The same by pointer doubling over slots, without contraction.

    Every finalized slot points at its finalized parent, the seed and slots without one at themselves; squaring the
    pointers reaches the roots in logarithmically many joins. A pointer that has reached its root takes no part any more, so no
    join gathers rows on a common root.
    """
    cut = checkpoint or (lambda df: df.checkpoint())
    final = states.where("finalized").groupBy("stream_name", "slot").agg(F.max("parent_slot").alias("parent_slot"))
    seeds = cut(_seeds(final, anchors))
    above = final.join(seeds.select("stream_name", "seed"), "stream_name").where("slot > seed")
    known = above.select("stream_name", "slot").union(seeds.select("stream_name", "seed"))
    linked = above.join(known.select("stream_name", F.col("slot").alias("parent_slot"), F.lit(True).alias("known")), ["stream_name", "parent_slot"], "left")
    up = F.coalesce(F.col("known") & (F.col("parent_slot") < F.col("slot")), F.lit(False))
    # ``done``: the pointer leads to the seed, or to a slot that leads nowhere.
    pointers = cut(linked.select("stream_name", "slot", F.when(up, F.col("parent_slot")).otherwise(F.col("slot")).alias("root"), (~up | (F.col("parent_slot") == F.col("seed"))).alias("done")))
    while not (open_ := pointers.where("not done")).isEmpty():
        onward = pointers.select("stream_name", F.col("slot").alias("root"), F.col("root").alias("next"), F.col("done").alias("there"))
        moved = open_.select("stream_name", "slot", "root").join(onward, ["stream_name", "root"]).select("stream_name", "slot", F.col("next").alias("root"), F.col("there").alias("done"))
        pointers = cut(pointers.where("done").unionByName(moved))
    reached = pointers.groupBy("stream_name", "root").agg(F.max("slot").alias("far"))
    return seeds.join(reached, (seeds["stream_name"] == reached["stream_name"]) & (seeds["seed"] == reached["root"]), "left").select(seeds["stream_name"], F.coalesce("far", "seed").alias("contiguous"), "head")


def advance_min_child(links: dict[int, list[int]], head: int) -> int:
    """The in-memory walk: follow the smallest child while it is larger."""
    while children := links.get(head):
        child = min(children)
        if child <= head:
            return head
        head = child
    return head


def open_gaps(states: DataFrame) -> DataFrame:
    """Finalized slots whose parent is not finalized: stream_name, slot, parent_slot, above (nearest finalized slot below).

    The slot below is looked up within ranges of slots, then among the last slots of the ranges below: no task orders a whole stream.
    """
    final = states.where("finalized").select("stream_name", "slot", "parent_slot", F.floor(F.col("slot") / SLOTS_PER_BUCKET).alias("_r"))
    tops = final.groupBy("stream_name", "_r").agg(F.max("slot").alias("_top"))
    tops = tops.withColumn("_below", F.max("_top").over(Window.partitionBy("stream_name").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))).drop("_top")
    below = final.withColumn("_lag", F.lag("slot").over(Window.partitionBy("stream_name", "_r").orderBy("slot"))).join(tops, ["stream_name", "_r"])
    below = below.withColumn("above", F.coalesce("_lag", "_below"))
    known = final.select("stream_name", F.col("slot").alias("parent_slot"))
    return below.where("parent_slot is not null and above is not null").join(known, ["stream_name", "parent_slot"], "left_anti").select("stream_name", "slot", "parent_slot", "above")


def merge_cursor(old: DataFrame, new: DataFrame, few: bool = False) -> DataFrame:
    """Cursors only grow; missing values count as nothing. ``few`` rows are merged in one task, without a shuffle."""
    columns = ("last_persisted_slot", "last_contiguous_finalized_slot", "last_finalized_slot")
    both = old.select("stream_name", *columns).unionByName(new.select("stream_name", *columns))
    return (both.coalesce(1) if few else both).groupBy("stream_name").agg(*[F.max(c).alias(c) for c in columns]).withColumn("last_persisted_slot", F.coalesce("last_persisted_slot", F.lit(0)))
