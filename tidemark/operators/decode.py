"""Token balance deltas and two-legged swaps out of event payloads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strict_json as J

#: Decoders by name; each takes event rows and returns a frame of its own.
DECODERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def decoder(name: str):
    def register(f: Callable[[DataFrame], DataFrame]):
        DECODERS[name] = f
        return f

    return register


def with_balances(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``balances`` (array of account, mint, pre, post) and ``decode_error``; one bad entry spoils the whole payload."""
    v = events.withColumn("_b", J.as_array(J.at(J.parse(F.col(payload)), "$.token_balances")))
    entry = lambda e: F.struct(
        F.coalesce(J.as_string(J.at(e, "$.account")), F.lit("")).alias("account"),
        F.coalesce(J.as_string(J.at(e, "$.mint")), F.lit("")).alias("mint"),
        J.as_i64(J.at(e, "$.pre")).alias("pre"),
        J.as_i64(J.at(e, "$.post")).alias("post"),
    )
    v = v.withColumn("balances", F.transform("_b", entry)).drop("_b")
    error = F.when(F.col("balances").isNull(), "missing token_balances").when(F.exists("balances", lambda b: b["pre"].isNull()), "invalid pre").when(F.exists("balances", lambda b: b["post"].isNull()), "invalid post")
    return v.withColumn("decode_error", error).withColumn("balances", F.when(F.col("decode_error").isNull(), F.col("balances")))


def delta(pre, post):
    """pre - post, so an outflow is positive; in decimals, as it may leave the signed 64-bit range."""
    return F.col(pre).cast("decimal(20,0)") - F.col(post).cast("decimal(20,0)")


@decoder("token_balances")
def balance_deltas(events: DataFrame, *keys: str) -> DataFrame:
    """One row for each balance: ``keys``, position, account, mint, pre_amount, post_amount, delta."""
    keys = keys or tuple(c for c in ("event_id", "slot", "signature", "program_id") if c in events.columns)
    rows = with_balances(events).where("decode_error is null").select(*keys, F.posexplode("balances").alias("position", "b"))
    return rows.select(*keys, "position", F.col("b.account").alias("account"), F.col("b.mint").alias("mint"), F.col("b.pre").alias("pre_amount"), F.col("b.post").alias("post_amount")).withColumn("delta", delta("pre_amount", "post_amount"))


def infer_swaps(deltas: DataFrame, *keys: str) -> DataFrame:
    """A row for each group of ``keys`` with its swap legs and ``reason`` (null for a swap).

    Exactly two non-zero deltas of opposite sign and different mints; the magnitudes may differ. The sender, whose
    delta is positive, gives token_in.
    """
    sign = F.signum("delta")
    legs = deltas.groupBy(*keys).agg(
        F.count_if(sign != 0).alias("legs"),
        F.count_if(sign > 0).alias("outs"),
        F.max(F.when(sign > 0, F.struct("mint", F.abs("delta").alias("amount")))).alias("o"),
        F.max(F.when(sign < 0, F.struct("mint", F.abs("delta").alias("amount")))).alias("i"),
    )
    reason = F.when(F.col("legs") != 2, "leg_count").when(F.col("outs") != 1, "sign").when(F.col("o.mint") == F.col("i.mint"), "same_mint")
    return legs.select(*keys, reason.alias("reason"), *[F.when(reason.isNull(), c).alias(n) for n, c in (("token_in", F.col("o.mint")), ("token_in_amount", F.col("o.amount")), ("token_out", F.col("i.mint")), ("token_out_amount", F.col("i.amount")))])


def swap_rows(inferred: DataFrame, *keys: str) -> DataFrame:
    """Rows of the swaps table; an amount beyond the signed 64-bit range is stored as -1."""
    fit = lambda c: F.when(F.col(c) <= F.lit(2**63 - 1).cast("decimal(20,0)"), F.col(c).cast("long")).otherwise(F.lit(-1)).alias(c)
    return inferred.where("reason is null").select(*keys, "token_in", fit("token_in_amount"), "token_out", fit("token_out_amount"))


@decoder("unknown_program")
def unknown_programs(events: DataFrame, known: tuple[str, ...] = ()) -> DataFrame:
    """Instructions of programs that no decoder covers."""
    return events.where((F.col("event_type") == "instruction") & ~F.col("program_id").isin(*known) if known else F.col("event_type") == "instruction").select("slot", "signature", "program_id")
