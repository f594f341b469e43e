"""Synthetic events by rule, of any number, without materializing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import wide

#: The program ids that instructions cycle through.
PROGRAM_IDS = ("11111111111111111111111111111111", "TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA", "ATokenGPvbdGVxr1b2hvZbsiqW5xWH25efTNsLJA8knL")


def _hex(c, width: int):
    return F.lower(F.lpad(F.hex(c.cast("long")), width, "0"))


def synthetic_events(spark: SparkSession, count: int, events_per_slot: int = 100, duplicate_ratio: float = 0.0, seed: int = 0) -> DataFrame:
    """Wide envelope rows and ``ordinal``. With duplicates, about that share of the positions repeats another position's event."""
    if not 0.0 <= duplicate_ratio <= 1.0:
        raise ValueError("duplicate_ratio must lie between 0.0 and 1.0")
    # Overwriting random positions count * ratio times leaves 1 - exp(-ratio) of them overwritten.
    hit = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)) < 1 - 2.718281828459045**-duplicate_ratio
    source = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(max(count, 1)))
    base = spark.range(count).select(F.col("id").alias("ordinal"), F.when(hit, source).otherwise(F.col("id")).alias("i") if duplicate_ratio else F.col("id").alias("i"))
    return events_by_rule(base, events_per_slot)


def events_by_rule(numbers: DataFrame, events_per_slot: int = 100) -> DataFrame:
    """The event that the rule makes of each number ``i``, with its ``ordinal``."""
    slot, index = F.floor(F.col("i") / events_per_slot).cast("long") + 1, F.col("i") % events_per_slot
    sig = F.concat(F.lit("sig-"), _hex(slot, 16), F.lit("-"), _hex(F.col("i"), 8))
    turn = F.col("i") % 4
    kind = F.when(turn == 1, "instruction").when(turn == 2, "account").when((turn == 3) & (index == events_per_slot - 1), "slot").otherwise("transaction")
    is_ = lambda *k: F.col("kind").isin(*k)
    rows = numbers.select("ordinal", "i", slot.alias("slot"), index.alias("n"), sig.alias("sig"), kind.alias("kind"))
    return wide(
        rows.select(
            "ordinal",
            "kind",
            F.lit("mainnet-beta").alias("cluster"),
            "slot",
            F.when(is_("account"), F.concat(F.lit("acct-"), _hex(F.col("slot"), 16), F.lit("-"), _hex(F.col("n"), 4))).alias("account"),
            F.when(is_("account"), F.col("n")).alias("write_version"),
            F.when(is_("account"), F.col("sig")).alias("txn_signature"),
            F.when(is_("account"), F.lit(False)).alias("is_startup"),
            F.when(is_("transaction", "instruction"), F.col("sig")).alias("signature"),
            F.when(is_("transaction"), F.col("n")).alias("index"),
            F.when(is_("instruction"), F.col("n")).alias("transaction_index"),
            F.when(is_("instruction"), F.col("n") % 16).alias("instruction_index"),
            F.when(is_("instruction"), F.element_at(F.array(*map(F.lit, PROGRAM_IDS)), (F.col("i") % 3 + 1).cast("int"))).alias("program_id"),
            F.when(is_("slot"), F.lit("finalized")).alias("status"),
            F.concat(F.lit('{"index":'), F.col("i").cast("string"), F.lit("}")).alias("payload"),
        )
    )


def to_jsonl(events: DataFrame, *keep: str) -> DataFrame:
    """A ``value`` column of replay lines, and the columns to keep."""
    from ..functions.identity import identity_json

    return events.select(*keep, F.concat(F.lit('{"identity":'), identity_json(), F.lit(',"payload":'), F.col("payload"), F.lit("}")).alias("value"))
