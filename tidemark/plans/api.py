"""Consumer queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 100


def clamp(limit: int | None) -> int:
    return max(1, min(DEFAULT_LIMIT if limit is None else limit, 1000))


def recent_events(events: DataFrame, event_type: str | None = None, limit: int | None = None) -> DataFrame:
    rows = events if event_type is None else events.where(F.col("event_type") == event_type)
    shown = [c for c in ("event_id", "slot", "event_type", "signature", "program_id", "payload", "inserted_at") if c in events.columns]
    return rows.select(*shown).orderBy(F.desc("slot"), F.desc_nulls_last("signature"), F.desc("event_id")).limit(clamp(limit))


def recent_swaps(swaps: DataFrame, program_id: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest swaps; ties of slot and signature are broken by the other columns."""
    rows = swaps if program_id is None else swaps.where(F.col("program_id") == program_id)
    shown = [c for c in ("slot", "signature", "program_id", "token_in", "token_in_amount", "token_out", "token_out_amount", "inferred_at") if c in swaps.columns]
    ties = [F.desc_nulls_last(c) for c in ("program_id", "token_in", "token_in_amount", "token_out", "token_out_amount")]
    return rows.select(*shown).orderBy(F.desc("slot"), F.desc_nulls_last("signature"), *ties).limit(clamp(limit))


def recent_slot_states(states: DataFrame, stream_name: str, limit: int | None = None) -> DataFrame:
    return states.where(F.col("stream_name") == stream_name).select("slot", "parent_slot", "finalized", "dead").orderBy(F.desc("slot")).limit(clamp(limit))


def stream_lag(cursors: DataFrame, stream_name: str) -> DataFrame:
    """One row with the three markers; a stream without cursor has (0, null, null)."""
    one = cursors.where(F.col("stream_name") == stream_name).agg(F.max("last_persisted_slot").alias("p"), F.max("last_contiguous_finalized_slot").alias("last_contiguous_finalized_slot"), F.max("last_finalized_slot").alias("last_finalized_slot"))
    return one.select(F.lit(stream_name).alias("stream_name"), F.coalesce("p", F.lit(0)).alias("last_persisted_slot"), "last_contiguous_finalized_slot", "last_finalized_slot")


def slot_lag(observed, persisted):
    return F.greatest(observed - persisted, F.lit(0))
