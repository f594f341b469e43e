"""First-write-wins dedup of event rows, within a batch and against a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_LONG, SLOTS_PER_BUCKET


def convertible(rows: DataFrame) -> DataFrame:
    """Rows that the events table can hold; larger slots are skipped."""
    return rows.where(F.col("slot") <= F.lit(MAX_LONG).cast("decimal(20,0)")).withColumn("slot", F.col("slot").cast("long"))


def slot_bucket(slot="slot"):
    """Equal ids have equal slots, so the bucket co-locates duplicates and prunes the table to a batch's own slots."""
    return F.floor(F.col(slot) / SLOTS_PER_BUCKET).cast("long")


def first_wins(rows: DataFrame, order: str = "ordinal", key: str = "event_id") -> DataFrame:
    """The earliest row of each key. An aggregate, so repeated rows are folded before the shuffle."""
    others = [c for c in rows.columns if c != key]
    packed = F.min_by(F.struct(*others), F.col(order)).alias("_first")
    out = rows.groupBy(key).agg(packed).select(key, "_first.*")
    return out.select(*rows.columns)


def new_rows(rows: DataFrame, table: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key the table does not hold; both sides carry ``slot_bucket``, by which the table is laid out."""
    if "slot_bucket" in rows.columns and "slot_bucket" in table.columns:
        return rows.join(table.select("slot_bucket", key), ["slot_bucket", key], "left_anti").select(*rows.columns)
    return rows.join(table.select(key), key, "left_anti")


def write_summary(rows: DataFrame, table: DataFrame | None = None, key: str = "event_id") -> DataFrame:
    """One row: attempted, inserted, deduplicated, skipped.

    ``attempted`` counts the convertible rows, or all rows where none is convertible.
    """
    fits = F.col("slot") <= F.lit(MAX_LONG).cast("decimal(20,0)")
    per = rows.groupBy(key).agg(F.count_if(fits).alias("ok"), F.count_if(~fits).alias("bad"))
    if table is not None:
        per = per.join(table.select(F.col(key), F.lit(True).alias("_held")).distinct(), key, "left")
        fresh = F.col("_held").isNull()
    else:
        fresh = F.lit(True)
    total = per.agg(F.coalesce(F.sum("ok"), F.lit(0)).alias("ok"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count_if((F.col("ok") > 0) & fresh).alias("inserted"))
    attempted = F.when(F.col("ok") == 0, F.col("bad")).otherwise(F.col("ok"))
    return total.select(attempted.alias("attempted"), "inserted", F.when(F.col("ok") == 0, F.lit(0)).otherwise(F.col("ok") - F.col("inserted")).cast("long").alias("deduplicated"), F.col("bad").alias("skipped"))
