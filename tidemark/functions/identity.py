"""Identity of an event: validation, canonical key, event id and the accessor columns, as column expressions."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import IDENTITY_FIELDS, KINDS

VERSION = 1


def blank(c: Column) -> Column:
    """True for a string without any character that is not Unicode white space."""
    return ~c.rlike(r"(?U)\S")


def escape(c: Column) -> Column:
    """Backslash first, then the two separators."""
    for char in ("\\", "|", "="):
        c = F.replace(c, F.lit(char), F.lit("\\" + char))
    return c


def _by_kind(branches: dict[str, Column], otherwise: Column | None = None) -> Column:
    out = reduce(lambda w, kc: w.when(F.col("kind") == kc[0], kc[1]) if w is not None else F.when(F.col("kind") == kc[0], kc[1]), branches.items(), None)
    return out if otherwise is None else out.otherwise(otherwise)


def _part(name: str, kind: str, optional: bool) -> list[Column]:
    c = F.col(name)
    if kind == "string":
        value = F.coalesce(F.concat(F.lit("some:"), escape(c)), F.lit("none")) if optional else escape(c)
    else:
        value = F.coalesce(c.cast("string"), F.lit("<none>")) if optional else c.cast("string")
    return [F.lit(f"{name}="), value]


def canonical_key() -> Column:
    tails = {}
    for k, fields in IDENTITY_FIELDS.items():
        parts: list[Column] = []
        for i, (name, kind, optional) in enumerate(fields):
            parts += ([F.lit("|")] if i else []) + _part(name, kind, optional)
        tails[k] = F.concat(*parts)
    return F.concat(F.lit(f"v={VERSION}|kind="), F.col("kind"), F.lit("|cluster="), escape(F.col("cluster")), F.lit("|slot="), F.col("slot").cast("string"), F.lit("|"), _by_kind(tails))


def event_id(key: Column | None = None) -> Column:
    return F.concat(F.lit("v1:"), F.sha2(canonical_key() if key is None else key, 256))


def invalid_field() -> Column:
    """Name of the first blank required string; null if the identity is valid."""
    checks = {k: F.coalesce(*[F.when(blank(F.col(n)) if optional else F.col(n).isNull() | blank(F.col(n)), F.lit(n)) for n, t, optional in (("cluster", "string", False), *fields) if t == "string" and n != "status"]) for k, fields in IDENTITY_FIELDS.items()}
    return F.when(F.col("kind").isNull() | ~F.col("kind").isin(*KINDS), F.lit("kind")).otherwise(_by_kind(checks))


def signature() -> Column:
    return _by_kind({"account": F.col("txn_signature"), "instruction": F.col("signature"), "transaction": F.col("signature")})


def program_id() -> Column:
    return _by_kind({"instruction": F.col("program_id")})


def account() -> Column:
    return _by_kind({"account": F.col("account")})


def identity_json() -> Column:
    """The identity as JSON with its kind's own fields, missing ones as null."""
    parts = {k: F.to_json(F.struct("kind", "cluster", "slot", *[F.col(n) for n, _, _ in fields]), {"ignoreNullFields": "false"}) for k, fields in IDENTITY_FIELDS.items()}
    return _by_kind(parts)


def wide(df: DataFrame) -> DataFrame:
    """Add the identity columns that are missing, typed, so that all kinds have one shape."""
    from ..schema import EVENT

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT.fields], *[c for c in df.columns if c not in EVENT.names])


@cache
def _event_columns() -> tuple[Column, ...]:
    """Bound to no frame, so one set serves all batches; building it takes longer than planning a small batch."""
    return (
        event_id().alias("event_id"),
        F.lit(VERSION).cast("short").alias("identity_version"),
        identity_json().alias("identity"),
        F.col("slot"),
        signature().alias("signature"),
        program_id().alias("program_id"),
        account().alias("account"),
        F.col("kind").alias("event_type"),
        F.col("payload"),
    )


def event_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Rows of the events table from wide envelope rows; ``slot`` stays a decimal so that the writer can judge it."""
    return df.select(*_event_columns(), *keep)
