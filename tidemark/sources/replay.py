"""Replay of JSON lines into wide envelope rows, strictly typed.

A line is bad if it is blank, is no JSON, lacks a field, has one of another type, or names a blank identity field.
``strict`` reports the smallest bad line of the file; ``skip`` leaves bad lines out; ``keep`` returns ``parse_error``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import strict_json as J
from ..functions.identity import invalid_field
from ..schema import IDENTITY_FIELDS, KINDS, STATUSES


class ReplaySourceError(ValueError):
    """The source can't be read."""


class ReplayError(ReplaySourceError):
    def __init__(self, line_number: int, reason: str):
        super().__init__(f"failed to parse replay line {line_number}: {reason}")
        self.line_number, self.reason = line_number, reason


_READ = {"string": J.as_string, "u64": J.as_u64, "bool": J.as_bool, "u16": lambda v: F.when(J.as_u64(v) <= 65535, J.as_u64(v).cast("int"))}


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Envelope columns, ``parse_error`` (null for a good line) and the other columns of ``lines``."""
    keep = [c for c in lines.columns if c != column]
    line = F.regexp_replace(F.col(column), r"\r$", "")
    parsed = lines.select(*keep, line.alias("_line"), J.parse(line).alias("_v"))
    identity = lambda f: J.at(F.col("_v"), f"$.identity.{f}")
    fields: dict[str, tuple[str, bool]] = {"kind": ("string", False), "cluster": ("string", False), "slot": ("u64", False)}
    fields |= {n: (t, o) for fs in IDENTITY_FIELDS.values() for n, t, o in fs}
    raw = parsed.select("*", *[identity(n).alias(f"_{n}") for n in fields], J.at(F.col("_v"), "$.payload").alias("_p"))
    typed = raw.select("*", *[_READ[t](F.col(f"_{n}")).alias(n) for n, (t, _) in fields.items()], F.col("_p").cast("string").alias("payload"))

    def wrong(kind: str) -> Column:
        """A required field that is missing or of another type, or an optional one of another type."""
        out = F.lit(False)
        for n, _, optional in IDENTITY_FIELDS[kind]:
            missing = F.col(n).isNull() & (F.col(f"_{n}").isNotNull() & ~J.is_null(F.col(f"_{n}")) if optional else F.lit(True))
            out = out | missing
        return out | ~F.col("status").isin(*STATUSES) if kind == "slot" else out

    mistyped = F.col("cluster").isNull() | F.col("slot").isNull() | F.col("kind").isNull() | ~F.col("kind").isin(*KINDS)
    for k in KINDS:
        mistyped = mistyped | ((F.col("kind") == k) & wrong(k))
    error = (
        F.when(F.trim("_line") == "", "empty line")
        .when(~F.col("_line").rlike(r"(?U)\S"), "empty line")
        .when(F.col("_v").isNull(), "invalid JSON")
        .when(F.coalesce(mistyped, F.lit(True)) | F.col("_p").isNull(), "invalid JSON")
        .when(invalid_field().isNotNull(), F.concat(F.lit("invalid identity: "), invalid_field()))
    )
    # The payload of JSON null is present and written as null text.
    payload = F.when(J.is_null(F.col("_p")), F.lit("null")).otherwise(F.col("payload"))
    # Through a generator, so that a filter on the error is not pushed below, where it would hold all of the parsing once more.
    row = F.struct(*fields, payload.alias("payload"), error.alias("parse_error"))
    return typed.select(*keep, F.explode(F.array(row)).alias("_r")).select("_r.*", *keep)


@dataclass
class Parsed:
    """A source that was parsed once. ``rows`` has the envelope, ``parse_error``, ``ordinal`` (from 0 in file order), ``source``, ``line_number``
    (from 1 in each file) and ``line`` (the text of a bad line only).
    """

    rows: DataFrame
    lines: int
    bad: int
    kinds: dict[str, int]
    last_slot: int | None

    @property
    def good(self) -> DataFrame:
        return self.rows.where("parse_error is null").drop("parse_error", "source", "line_number", "line")

    def check(self) -> None:
        """Raise the first bad line of the source."""
        if self.bad:
            first = self.rows.where("parse_error is not null").agg(F.min(F.struct("ordinal", "line_number", "parse_error")).alias("b")).first()["b"]
            raise ReplayError(first["line_number"], first["parse_error"])


def parse_once(spark: SparkSession, path: str, cut: Callable[[DataFrame], DataFrame]) -> Parsed:
    """Parse each line of a file or folder once, into a table that ``cut`` writes and reads back, counting on the way.

    A line's number is the sum of the lines of the splits before its own and its place there. A task numbers its rows as it reads, and a split's rows
    follow each other in a task, so the splits' sizes and first numbers give all of them; there is a row for each split, as in Spark's own plan of
    the scan.
    """
    try:
        text = _text(spark, path)
    except AnalysisException as e:
        raise ReplaySourceError(str(e)) from e
    lines = text.select("value", F.col("value").alias("line"), F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    ok, told = F.col("parse_error").isNull(), Observation()
    counts = [F.count_if(ok & (F.col("kind") == k)).alias(k) for k in KINDS]
    parsed = parse_lines(lines).withColumn("line", F.when(~ok, F.col("line")))
    last = F.max_by(F.col("slot"), F.when(ok, F.struct("source", "_start", "_at"))).alias("last")
    laid = cut(parsed.observe(told, F.count(F.lit(1)).alias("n"), F.count_if(~ok).alias("bad"), last, *counts))
    seen = told.get
    splits = sorted(map(tuple, laid.groupBy("source", "_start").agg(F.count("*"), F.min("_at")).collect()))
    starts, before, within, of = [], 0, 0, None
    for source, start, n, first in splits:
        within = within if source == of else 0
        starts.append((source, start, before - first, within + 1 - first))
        before, within, of = before + n, within + n, source
    shifts = spark.createDataFrame(starts, "source string, _start long, _all long, _own long")
    rows = laid.join(F.broadcast(shifts), ["source", "_start"]).withColumn("ordinal", F.col("_at") + F.col("_all")).withColumn("line_number", F.col("_at") + F.col("_own")).drop("_at", "_start", "_all", "_own")
    last_slot = seen.get("last")
    return Parsed(rows, seen.get("n", 0), seen.get("bad", 0), {k: seen[k] for k in KINDS if seen.get(k)}, None if last_slot is None else int(last_slot))


def _text(spark: SparkSession, path: str) -> DataFrame:
    """Lines end at a line feed only, as a lone carriage return is part of a line."""
    return spark.read.option("lineSep", "\n").text(path)


def _persisted(df: DataFrame) -> DataFrame:
    df = df.persist()
    df.count()
    return df


def read_jsonl(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Envelope columns and ``ordinal``, which grows in file order. Lazy: a use of the rows parses the lines; ``parse_once`` keeps what it parsed."""
    rows = parse_lines(_text(spark, path).withColumn("ordinal", F.monotonically_increasing_id()))
    if mode == "keep":
        return rows
    bad = F.col("parse_error").isNotNull()
    if mode == "strict" and not rows.where(bad).isEmpty():
        parse_once(spark, path, _persisted).check()
    return rows.where(~bad).drop("parse_error")
