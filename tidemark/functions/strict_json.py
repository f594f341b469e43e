"""Strict JSON typing on VARIANT: what a typed decoder accepts, without coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(c: Column) -> Column:
    return F.try_parse_json(c)


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def type_of(v: Column) -> Column:
    return F.schema_of_variant(v)


def present(v: Column) -> Column:
    return v.isNotNull()


def is_i64(v: Column) -> Column:
    return type_of(v) == "BIGINT"


def as_i64(v: Column) -> Column:
    """A JSON integer of the signed 64-bit range; null for anything else, also for 1.0 and "1"."""
    return F.when(is_i64(v), F.try_variant_get(v, "$", "bigint"))


def as_u64(v: Column) -> Column:
    """A non-negative JSON integer up to 2^64-1. From 2^63 on an integer looks like a decimal of the same size (accepted)."""
    t = type_of(v)
    n = F.when((t == "BIGINT") | t.isin("DECIMAL(19,0)", "DECIMAL(20,0)"), F.try_variant_get(v, "$", "decimal(20,0)"))
    return F.when((n >= 0) & (n <= F.lit("18446744073709551615").cast("decimal(20,0)")), n)


def as_string(v: Column) -> Column:
    return F.when(type_of(v) == "STRING", F.try_variant_get(v, "$", "string"))


def as_bool(v: Column) -> Column:
    return F.when(type_of(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))


def is_null(v: Column) -> Column:
    return F.is_variant_null(v)


def as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")
