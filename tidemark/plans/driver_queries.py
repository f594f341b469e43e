"""Every operator run over the supplied tables, each with the SQL that must give the same rows.

Derivations (both engines): EV makes account events of ``events``, RAW raw events of all kinds, SL slot states of
``orders`` (one stream for each priority), TB token balances of ``lineitem``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strict_json as J
from ..functions.identity import account, canonical_key, event_id, event_rows, invalid_field, program_id, signature, wide
from ..metrics import LATENCY_BOUNDS, ingest_counts, latency_histogram
from ..operators import decode, dedup, normalize, slots
from ..schema import UPDATE
from ..sources.generate import events_by_rule, to_jsonl
from ..sources.replay import parse_lines, parse_once
from . import api, pipeline
from .tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- derivations ----------------------------------------------------------------------------------------------------

EV = """
ev AS (SELECT event_id AS ordinal, event_id // 100 + 1 AS slot, 'user-' || user_id AS account, regexp_extract(props, '[0-9]+')::BIGINT % 5 AS write_version, event_type AS type, value FROM events),
ek AS (SELECT *, 'v=1|kind=account|cluster=mainnet-beta|slot=' || slot || '|account=' || account || '|write_version=' || write_version || '|txn_signature=none|is_startup=false' AS k FROM ev),
ei AS (SELECT *, 'v1:' || sha256(k) AS eid FROM ek)
"""


def ev(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events")
    return wide(
        e.select(
            F.col("event_id").alias("ordinal"),
            F.lit("account").alias("kind"),
            F.lit("mainnet-beta").alias("cluster"),
            (F.floor(F.col("event_id") / 100) + 1).alias("slot"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("account"),
            (F.regexp_extract("props", "[0-9]+", 0).cast("long") % 5).alias("write_version"),
            F.lit(False).alias("is_startup"),
            F.col("props").alias("payload"),
            F.col("event_type").alias("type"),
            "value",
        )
    )


RAW = """
rw AS (SELECT event_id AS ordinal, event_id // 100 + 1 AS slot, ['transaction', 'account', 'instruction', 'slot', 'block', 'entry'][event_id % 6 + 1] AS kind,
  CASE WHEN event_id % 70 = 0 THEN ' ' ELSE 'sig-' || event_id END AS sig, 'program-' || (user_id % 7) AS prog, 'user-' || user_id AS acct,
  ['processed', 'confirmed', 'finalized', 'dead', 'rooted'][event_id % 5 + 1] AS status, CASE WHEN event_id % 90 = 4 THEN '' ELSE 'hash|' || event_id END AS bh,
  CASE WHEN event_id % 110 = 5 THEN chr(9) ELSE 'main=net' END AS cluster FROM events),
rk AS (SELECT *, 'v=1|kind=' || kind || '|cluster=' || replace(cluster, '=', '\\=') || '|slot=' || slot || '|' || CASE kind
  WHEN 'transaction' THEN 'signature=' || sig || '|index=' || (ordinal % 100)
  WHEN 'account' THEN 'account=' || acct || '|write_version=' || (ordinal % 9) || '|txn_signature=' || CASE WHEN ordinal % 4 = 1 THEN 'none' ELSE 'some:' || sig END || '|is_startup=' || CASE WHEN ordinal % 8 = 3 THEN 'true' ELSE 'false' END
  WHEN 'instruction' THEN 'signature=' || sig || '|transaction_index=' || (ordinal % 100) || '|instruction_index=' || (ordinal % 16) || '|inner_instruction_index=' || CASE WHEN ordinal % 4 = 0 THEN '<none>' ELSE (ordinal % 3)::VARCHAR END || '|program_id=' || prog
  WHEN 'slot' THEN 'status=' || status WHEN 'block' THEN 'blockhash=' || replace(bh, '|', '\\|') ELSE 'index=' || (ordinal % 100) END AS k FROM rw)
"""


def raw(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events").withColumn("i", F.col("event_id"))
    pick = lambda xs, c: F.element_at(F.array(*map(F.lit, xs)), (c + 1).cast("int"))
    kind = pick(("transaction", "account", "instruction", "slot", "block", "entry"), F.col("i") % 6)
    text = lambda p: F.concat(F.lit(p), F.col("i").cast("string"))
    sig = F.when(F.col("i") % 70 == 0, " ").otherwise(text("sig-"))
    k = lambda *ks: F.col("kind").isin(*ks)
    rows = e.withColumn("kind", kind)
    return wide(
        rows.select(
            F.col("i").alias("ordinal"),
            "kind",
            F.when(F.col("i") % 110 == 5, "\t").otherwise("main=net").alias("cluster"),
            (F.floor(F.col("i") / 100) + 1).alias("slot"),
            F.when(k("account"), F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("account"),
            F.when(k("account"), F.col("i") % 9).alias("write_version"),
            F.when(k("account") & (F.col("i") % 4 != 1), sig).alias("txn_signature"),
            F.when(k("account"), F.col("i") % 8 == 3).alias("is_startup"),
            F.when(k("transaction", "instruction"), sig).alias("signature"),
            F.when(k("transaction", "entry"), F.col("i") % 100).alias("index"),
            F.when(k("instruction"), F.col("i") % 100).alias("transaction_index"),
            F.when(k("instruction"), F.col("i") % 16).alias("instruction_index"),
            F.when(k("instruction") & (F.col("i") % 4 != 0), F.col("i") % 3).alias("inner_instruction_index"),
            F.when(k("instruction"), F.concat(F.lit("program-"), (F.col("user_id") % 7).cast("string"))).alias("program_id"),
            F.when(k("slot"), pick(("processed", "confirmed", "finalized", "dead", "rooted"), F.col("i") % 5)).alias("status"),
            F.when(k("block"), F.when(F.col("i") % 90 == 4, "").otherwise(text("hash|"))).alias("blockhash"),
            F.col("props").alias("payload"),
        )
    )


def _sl_sql(drop: str = "o_orderkey % 1000 <> 7", back: str = "prev") -> str:
    return f"""
fk AS (SELECT o_orderpriority AS s, o_orderkey AS k, o_orderstatus AS st, max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM orders),
sl AS (SELECT s AS stream_name, k AS slot, {back} AS parent_slot, st = 'F' AS finalized, st = 'P' AS dead FROM fk WHERE st <> 'O' AND {drop.replace("o_orderkey", "k")}),
fin AS (SELECT * FROM sl WHERE finalized)
"""


def sl(spark: SparkSession, sf: str, gaps: bool = True) -> DataFrame:
    o = _t(spark, sf, "orders").select(F.col("o_orderpriority").alias("stream_name"), F.col("o_orderkey").alias("slot"), F.col("o_orderstatus").alias("st"))
    before = Window.partitionBy("stream_name").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rows = o.withColumn("parent_slot", F.max(F.when(F.col("st") == "F", F.col("slot"))).over(before)).where("st <> 'O'")
    rows = rows.where("slot % 1000 <> 7") if gaps else rows
    return rows.select("stream_name", "slot", "parent_slot", (F.col("st") == "F").alias("finalized"), (F.col("st") == "P").alias("dead"), F.col("slot").alias("ordinal"))


TB = """
tb AS (SELECT l_orderkey AS slot, 'sig-' || l_orderkey AS signature, 'program-' || (l_orderkey % 7) AS program_id, l_linenumber::VARCHAR AS account, 'mint-' || (l_partkey % 5) AS mint, 1000::BIGINT AS pre_amount,
  (1000 - CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END)::BIGINT AS post_amount FROM lineitem),
td AS (SELECT *, pre_amount - post_amount AS delta FROM tb),
tg AS (SELECT slot, signature, program_id, count(*) FILTER (delta <> 0) AS legs, count(*) FILTER (delta > 0) AS outs,
  max({'mint': mint, 'amount': delta}) FILTER (delta > 0) AS o, max({'mint': mint, 'amount': -delta}) FILTER (delta < 0) AS i FROM td GROUP BY ALL),
ts AS (SELECT slot, signature, program_id, CASE WHEN legs <> 2 THEN 'leg_count' WHEN outs <> 1 THEN 'sign' WHEN o.mint = i.mint THEN 'same_mint' END AS reason,
  o.mint AS token_in, o.amount::BIGINT AS token_in_amount, i.mint AS token_out, i.amount::BIGINT AS token_out_amount FROM tg)
"""


def tb(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    change = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(-F.col("l_quantity"))
    key = F.col("l_orderkey").cast("string")
    return li.select(
        F.col("l_orderkey").alias("slot"),
        F.concat(F.lit("sig-"), key).alias("signature"),
        F.concat(F.lit("program-"), (F.col("l_orderkey") % 7).cast("string")).alias("program_id"),
        F.col("l_linenumber").cast("string").alias("account"),
        F.concat(F.lit("mint-"), (F.col("l_partkey") % 5).cast("string")).alias("mint"),
        F.lit(1000).cast("long").alias("pre_amount"),
        (1000 - change).cast("long").alias("post_amount"),
    ).withColumn("delta", decode.delta("pre_amount", "post_amount"))


def swaps(spark: SparkSession, sf: str) -> DataFrame:
    keys = ("slot", "signature", "program_id")
    return decode.swap_rows(decode.infer_swaps(tb(spark, sf), *keys), *keys)


# ---- identity and normalization -------------------------------------------------------------------------------------

@query(f"""WITH {RAW} SELECT ordinal, kind, slot::BIGINT AS slot,
  CASE WHEN kind IN ('transaction', 'instruction') THEN sig WHEN kind = 'account' AND ordinal % 4 <> 1 THEN sig END AS signature,
  CASE WHEN kind = 'instruction' THEN prog END AS program_id, CASE WHEN kind = 'account' THEN acct END AS account,
  CASE WHEN kind IN ('transaction', 'instruction') AND trim(sig) = '' THEN 'missing field: signature' WHEN kind = 'block' AND bh = '' THEN 'missing field: blockhash'
    WHEN kind = 'account' AND ordinal % 4 <> 1 AND trim(sig) = '' THEN 'missing field: txn_signature' WHEN kind = 'slot' AND status = 'rooted' THEN 'invalid slot status: rooted'
    WHEN cluster = chr(9) THEN 'invalid identity: cluster' END AS error FROM rk""")
def normalize_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize.normalize(raw(spark, sf))
    return rows.select("ordinal", "kind", F.col("slot").cast("long").alias("slot"), signature().alias("signature"), program_id().alias("program_id"), account().alias("account"), "error")


@query(f"WITH {RAW} SELECT ordinal, k AS canonical_key FROM rk")
def canonical_keys(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf).select("ordinal", canonical_key().alias("canonical_key"))


@query(f"WITH {RAW} SELECT ordinal, 'v1:' || sha256(k) AS event_id FROM rk")
def event_ids(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf).select("ordinal", event_id().alias("event_id"))


@query(r"""SELECT c_custkey AS id, 'v=1|kind=transaction|cluster=' || replace(replace(replace('a|b=' || c_name || '\', '\', '\\'), '|', '\|'), '=', '\=') || '|slot=' || c_custkey || '|signature=' || replace(replace(replace('\|' || c_mktsegment || '==', '\', '\\'), '|', '\|'), '=', '\=') || '|index=0' AS canonical_key FROM customer""")
def identity_escape(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    rows = wide(c.select(F.lit("transaction").alias("kind"), F.concat(F.lit("a|b="), "c_name", F.lit("\\")).alias("cluster"), F.col("c_custkey").alias("slot"), F.concat(F.lit("\\|"), "c_mktsegment", F.lit("==")).alias("signature"), F.lit(0).alias("index"), F.col("c_custkey").alias("id")))
    return rows.select("id", canonical_key().alias("canonical_key"))


@query(f"""WITH {RAW} SELECT ordinal, CASE WHEN cluster = chr(9) THEN 'cluster' WHEN kind IN ('transaction', 'instruction') AND trim(sig) = '' THEN 'signature' WHEN kind = 'block' AND bh = '' THEN 'blockhash'
  WHEN kind = 'account' AND ordinal % 4 <> 1 AND trim(sig) = '' THEN 'txn_signature' END AS invalid_field FROM rk""")
def identity_validation(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf).select("ordinal", invalid_field().alias("invalid_field"))


@query(f"WITH {RAW} SELECT 'replay' AS source, kind AS event_type, count(*) AS n FROM rk GROUP BY kind")
def kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_counts(raw(spark, sf).select(F.col("kind").alias("event_type")), "replay")


@query("""SELECT event_id AS ordinal, CASE WHEN event_id % 10 = 0 THEN 'empty line' WHEN event_id % 10 IN (1, 2, 3, 4) THEN 'invalid JSON' WHEN event_id % 10 = 5 THEN 'invalid identity: signature' END AS parse_error,
  CASE WHEN event_id % 10 > 5 THEN event_id END AS slot, CASE WHEN event_id % 10 > 5 THEN user_id END AS index FROM events""")
def replay_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse_lines(_lines(spark, sf).withColumnRenamed("event_id", "ordinal"))
    return _parsed(rows)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """event_id and ``value``: a replay line of each event, four in ten good, the others bad in six ways."""
    e, m = _t(spark, sf, "events"), F.col("event_id") % 10
    line = lambda slot, sig, tail: F.concat(F.lit('{"identity":{"kind":"transaction","cluster":"c","slot":'), slot, F.lit(f',"signature":{sig},"index":'), F.col("user_id").cast("string"), F.lit(f"}}{tail}}}"))
    n = F.col("event_id").cast("string")
    value = (
        F.when(m == 0, "   ").when(m == 1, "not json").when(m == 2, line(F.concat(F.lit('"'), n, F.lit('"')), '"s"', ',"payload":1')).when(m == 3, line(n, "5", ',"payload":1'))
        .when(m == 4, line(n, '"s"', "")).when(m == 5, line(n, '" "', ',"payload":1')).when(m == 6, line(n, '"s"', ',"payload":null')).otherwise(line(n, '"s"', ',"payload":{"x":[1]},"more":2'))
    )
    return e.select("event_id", value.alias("value"))


def _parsed(rows: DataFrame) -> DataFrame:
    ok = F.col("parse_error").isNull()
    return rows.select("ordinal", "parse_error", F.when(ok, F.col("slot").cast("long")).alias("slot"), F.when(ok, F.col("index").cast("long")).alias("index"))


def _written(spark: SparkSession, sf: str) -> str:
    """The lines in files, with carriage returns, the files' names and their lines in the order of events."""
    path = _scratch(spark, "lines")
    _lines(spark, sf).repartitionByRange("event_id").sortWithinPartitions("event_id").select(F.concat("value", F.lit("\r")).alias("value")).write.text(path)
    return path


@query("""SELECT row_number() OVER (ORDER BY event_id) - 1 AS ordinal, CASE WHEN event_id % 10 = 0 THEN 'empty line' WHEN event_id % 10 IN (1, 2, 3, 4) THEN 'invalid JSON' WHEN event_id % 10 = 5 THEN 'invalid identity: signature' END AS parse_error,
  CASE WHEN event_id % 10 > 5 THEN event_id END AS slot, CASE WHEN event_id % 10 > 5 THEN user_id END AS index FROM events""")
def replay_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of files with carriage returns, numbered in file order by the pass that parses them."""
    return _parsed(parse_once(spark, _written(spark, sf), lambda df: _saved(spark, df)).rows)


@query("""WITH l AS (SELECT event_id % 10 AS m, event_id AS n, '{"identity":{"kind":"transaction","cluster":"c","slot":' AS head, ',"index":' || user_id || '}' AS tail FROM events)
SELECT 's' AS stream_name, CASE WHEN m = 0 THEN 'empty line' WHEN m = 5 THEN 'invalid identity: signature' ELSE 'invalid JSON' END AS reason,
  CASE m WHEN 0 THEN '   ' WHEN 1 THEN 'not json' WHEN 2 THEN head || '"' || n || '","signature":"s"' || tail || ',"payload":1}' WHEN 3 THEN head || n || ',"signature":5' || tail || ',"payload":1}' WHEN 4 THEN head || n || ',"signature":"s"' || tail || '}' ELSE head || n || ',"signature":" "' || tail || ',"payload":1}' END || chr(13) AS line
FROM l WHERE m < 6""")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Files with bad lines, replayed twice: what was put aside, once."""
    tables, path = Tables(spark, _scratch(spark, "letters")), _written(spark, sf)
    for _ in range(2):
        pipeline.replay_file(tables, path, "s", "divert")
    return tables.read("dead_letters").select("stream_name", "reason", "line")


@query("""SELECT event_id AS ordinal, CASE event_id % 6 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'DECIMAL' WHEN 2 THEN 'DOUBLE' WHEN 3 THEN 'STRING' WHEN 4 THEN 'VOID' ELSE 'ARRAY' END AS kind, CASE WHEN event_id % 6 = 0 THEN event_id END AS number FROM events""")
def payload_type_checks(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id").cast("string")
    m = F.col("event_id") % 6
    text = F.when(m == 0, n).when(m == 1, F.concat(n, F.lit(".0"))).when(m == 2, F.concat(n, F.lit("e0"))).when(m == 3, F.concat(F.lit('"'), n, F.lit('"'))).when(m == 4, "null").otherwise(F.concat(F.lit("["), n, F.lit("]")))
    v = _t(spark, sf, "events").select(F.col("event_id").alias("ordinal"), J.at(J.parse(F.concat(F.lit('{"x":'), text, F.lit("}"))), "$.x").alias("v"))
    return v.select("ordinal", F.regexp_extract(J.type_of(F.col("v")), "^[A-Z]+", 0).alias("kind"), J.as_i64(F.col("v")).alias("number"))


# ---- dedup, batches and cursors -------------------------------------------------------------------------------------

@query(f"WITH {EV} SELECT eid AS event_id, ordinal, value FROM ei QUALIFY row_number() OVER (PARTITION BY eid ORDER BY ordinal) = 1")
def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_wins(ev(spark, sf).select(event_id().alias("event_id"), "ordinal", "value"))


@query(f"WITH {EV} SELECT count(*) AS attempted, count(DISTINCT eid) AS inserted, count(*) - count(DISTINCT eid) AS deduplicated, 0::BIGINT AS skipped FROM ei")
def write_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.write_summary(ev(spark, sf).select(event_id().alias("event_id"), "slot"))


@query(f"""WITH {EV}, a AS (SELECT DISTINCT eid FROM ei WHERE ordinal % 3 <> 0), b AS (SELECT eid FROM ei WHERE ordinal % 3 = 0), n AS (SELECT count(DISTINCT eid) AS n FROM b WHERE eid NOT IN (SELECT eid FROM a))
SELECT count(*) AS attempted, any_value(n.n) AS inserted, count(*) - any_value(n.n) AS deduplicated, 0::BIGINT AS skipped FROM b, n""")
def incremental_write_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).select(event_id().alias("event_id"), "slot", "ordinal")
    return dedup.write_summary(rows.where("ordinal % 3 = 0"), rows.where("ordinal % 3 <> 0"))


@query(f"""WITH {EV} SELECT eid AS event_id, min(ordinal) AS ordinal FROM ei WHERE ordinal % 3 = 0 AND eid NOT IN (SELECT eid FROM ei WHERE ordinal % 3 <> 0) GROUP BY eid""")
def incremental_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).select(event_id().alias("event_id"), dedup.slot_bucket().alias("slot_bucket"), "ordinal")
    fresh = dedup.first_wins(rows.where("ordinal % 3 = 0"))
    return dedup.new_rows(fresh, rows.where("ordinal % 3 <> 0")).select("event_id", "ordinal")


@query(f"WITH {EV} SELECT ordinal, slot::BIGINT AS slot FROM ei WHERE slot > 50")
def resume_filter(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.resume(ev(spark, sf), 50).select("ordinal", F.col("slot").cast("long").alias("slot"))


_BATCHES = "b AS (SELECT (row_number() OVER (ORDER BY ordinal) - 1) // 500 AS batch_no, slot FROM ei), g AS (SELECT batch_no, count(*) AS n_events, max(slot)::BIGINT AS max_slot FROM b GROUP BY batch_no)"


@query(f"WITH {EV}, {_BATCHES} SELECT batch_no::BIGINT AS batch_no, n_events, max_slot FROM g")
def logical_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).withColumn("slot", F.col("slot").cast("long"))
    return pipeline.logical_batches(rows).select("batch_no", "n_events", "max_slot")


@query(f"WITH {EV}, {_BATCHES} SELECT batch_no::BIGINT AS batch_no, max(max_slot) OVER (ORDER BY batch_no) AS cursor FROM g")
def cursor_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).withColumn("slot", F.col("slot").cast("long"))
    return pipeline.logical_batches(rows).select("batch_no", "cursor")


@query("""SELECT o_orderpriority AS stream_name, greatest(max(o_orderkey) FILTER (o_orderkey % 2 = 0), max(o_orderkey) FILTER (o_orderkey % 2 = 1))::BIGINT AS last_persisted_slot, max(o_orderkey) FILTER (o_orderkey % 2 = 0 AND o_orderstatus = 'F') AS last_contiguous_finalized_slot, NULL::BIGINT AS last_finalized_slot FROM orders GROUP BY 1""")
def cursor_upsert(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    top = lambda m, f: o.where(f"o_orderkey % 2 = {m}").groupBy(F.col("o_orderpriority").alias("stream_name")).agg(F.max("o_orderkey").alias("last_persisted_slot"), F.max(F.when(F.lit(f) & (F.col("o_orderstatus") == "F"), F.col("o_orderkey"))).alias("last_contiguous_finalized_slot"), F.lit(None).cast("long").alias("last_finalized_slot"))
    return slots.merge_cursor(top(0, True), top(1, False))


# ---- slots and frontier ---------------------------------------------------------------------------------------------

@query("""SELECT l_suppkey AS slot, arg_max(l_partkey, l_orderkey * 100 + l_linenumber) FILTER (l_returnflag <> 'A') AS parent_slot, bool_or(l_linestatus = 'F') AS finalized, bool_or(l_returnflag = 'R') AS dead FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) GROUP BY l_suppkey""")
def slot_state_merge(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    first = li.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")).alias("f")).select("l_orderkey", "l_linenumber", "f.*")
    rows = first.select(F.col("l_suppkey").alias("slot"), F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("parent_slot"), (F.col("l_linestatus") == "F").alias("finalized"), (F.col("l_returnflag") == "R").alias("dead"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ordinal"))
    return slots.merge_states(rows)


@query(f"WITH {_sl_sql()} SELECT stream_name, slot, CASE WHEN slot % 3 = 0 THEN coalesce(CASE WHEN slot % 6 = 0 THEN parent_slot + 1 END, parent_slot) ELSE parent_slot END AS parent_slot, finalized OR slot % 3 = 0 AS finalized, dead FROM sl")
def slot_state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = sl(spark, sf)
    new = old.where("slot % 3 = 0").select("stream_name", "slot", F.when(F.col("slot") % 6 == 0, F.col("parent_slot") + 1).alias("parent_slot"), F.lit(True).alias("finalized"), F.lit(False).alias("dead"))
    return slots.upsert_states(old, new, "stream_name").select("stream_name", "slot", "parent_slot", "finalized", "dead")


_WALK = """r AS (SELECT stream_name, min(slot) AS slot FROM fin GROUP BY 1 UNION ALL SELECT f.stream_name, f.slot FROM r JOIN fin f ON f.stream_name = r.stream_name AND f.parent_slot = r.slot AND f.slot > r.slot)
SELECT stream_name, max(slot) AS contiguous, (SELECT max(slot) FROM fin WHERE fin.stream_name = r.stream_name) AS head FROM r GROUP BY stream_name"""


@query(f"WITH RECURSIVE {_sl_sql()}, {_WALK}")
def finalized_frontier(spark: SparkSession, sf: str) -> DataFrame:
    return slots.finalized_frontier(sl(spark, sf), None, lambda df: _saved(spark, df))


@query(f"WITH RECURSIVE {_sl_sql()}, {_WALK}")
def finalized_frontier_doubling(spark: SparkSession, sf: str) -> DataFrame:
    return slots.finalized_frontier_doubling(sl(spark, sf), lambda df: _saved(spark, df))


@query(f"WITH RECURSIVE {_sl_sql('true')}, {_WALK}")
def frontier_after_gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    return slots.finalized_frontier(sl(spark, sf, gaps=False), None, lambda df: _saved(spark, df))


@query(f"""WITH RECURSIVE {_sl_sql()}, s AS (SELECT stream_name, min(slot) + 100 AS slot FROM fin GROUP BY 1),
r AS (SELECT * FROM s UNION ALL SELECT f.stream_name, f.slot FROM r JOIN fin f ON f.stream_name = r.stream_name AND f.parent_slot = r.slot AND f.slot > r.slot)
SELECT stream_name, max(slot) AS contiguous, (SELECT max(slot) FROM fin WHERE fin.stream_name = r.stream_name) AS head FROM r GROUP BY stream_name""")
def frontier_from_anchor(spark: SparkSession, sf: str) -> DataFrame:
    states = sl(spark, sf)
    return slots.finalized_frontier(states, states.where("finalized").groupBy("stream_name").agg((F.min("slot") + 100).alias("anchor")), lambda df: _saved(spark, df))


@query(f"WITH RECURSIVE {_sl_sql('true', back='CASE WHEN k % 5 = 0 THEN (SELECT max(x.k) FROM fk x WHERE x.s = fk.s AND x.st = chr(70) AND x.k < fk.prev) ELSE prev END')}, {_WALK}")
def frontier_fork(spark: SparkSession, sf: str) -> DataFrame:
    states = sl(spark, sf, gaps=False).where("finalized")
    w = Window.partitionBy("stream_name").orderBy("slot")
    return slots.finalized_frontier(states.withColumn("parent_slot", F.when(F.col("slot") % 5 == 0, F.lag("slot", 2).over(w)).otherwise(F.col("parent_slot"))), None, lambda df: _saved(spark, df))


@query(f"WITH {_sl_sql()} SELECT stream_name, slot, parent_slot, (SELECT max(b.slot) FROM fin b WHERE b.stream_name = f.stream_name AND b.slot < f.slot) AS above FROM fin f WHERE parent_slot IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fin p WHERE p.stream_name = f.stream_name AND p.slot = f.parent_slot) AND above IS NOT NULL")
def open_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return slots.open_gaps(sl(spark, sf))


# ---- consumer queries -----------------------------------------------------------------------------------------------

@query(f"WITH {EV}, u AS (SELECT DISTINCT eid AS event_id, slot::BIGINT AS slot FROM ei) SELECT event_id, slot, 'account' AS event_type, NULL::VARCHAR AS signature, NULL::VARCHAR AS program_id FROM u ORDER BY slot DESC, event_id DESC LIMIT 100")
def recent_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.first_wins(dedup.convertible(event_rows(ev(spark, sf), "ordinal")))
    return api.recent_events(rows).drop("payload")


@query(f"WITH {RAW}, u AS (SELECT DISTINCT 'v1:' || sha256(k) AS event_id, slot::BIGINT AS slot, sig, prog FROM rk WHERE kind = 'instruction') SELECT event_id, slot, 'instruction' AS event_type, sig AS signature, prog AS program_id FROM u ORDER BY slot DESC, sig DESC, event_id DESC LIMIT 1000")
def recent_events_by_type(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.first_wins(dedup.convertible(event_rows(raw(spark, sf), "ordinal")))
    return api.recent_events(rows, "instruction", 5000).drop("payload")


_SWAPS = "SELECT slot, signature, program_id, token_in, token_in_amount, token_out, token_out_amount FROM ts WHERE reason IS NULL"


@query(f"WITH {TB} {_SWAPS} ORDER BY slot DESC, signature DESC LIMIT 100")
def recent_swaps(spark: SparkSession, sf: str) -> DataFrame:
    return api.recent_swaps(swaps(spark, sf))


@query(f"WITH {TB} {_SWAPS} AND program_id = 'program-3' ORDER BY slot DESC, signature DESC LIMIT 10")
def recent_swaps_by_program(spark: SparkSession, sf: str) -> DataFrame:
    return api.recent_swaps(swaps(spark, sf), "program-3", 10)


@query(f"WITH {_sl_sql()} SELECT slot, parent_slot, finalized, dead FROM sl WHERE stream_name = (SELECT min(o_orderpriority) FROM orders) ORDER BY slot DESC LIMIT 100")
def recent_slot_states(spark: SparkSession, sf: str) -> DataFrame:
    first = _t(spark, sf, "orders").agg(F.min("o_orderpriority")).first()[0]
    return api.recent_slot_states(sl(spark, sf), first)


@query("""WITH s(stream_name) AS (SELECT DISTINCT o_orderpriority FROM orders UNION ALL SELECT 'missing'), c AS (SELECT o_orderpriority AS n, max(o_orderkey) AS p, max(o_orderkey) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
SELECT stream_name, coalesce(p, 0)::BIGINT AS last_persisted_slot, f - 1 AS last_contiguous_finalized_slot, f AS last_finalized_slot FROM s LEFT JOIN c ON n = stream_name""")
def stream_lag(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    top = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))
    cursors = o.groupBy(F.col("o_orderpriority").alias("stream_name")).agg(F.max("o_orderkey").alias("last_persisted_slot"), (top - 1).alias("last_contiguous_finalized_slot"), top.alias("last_finalized_slot"))
    names = o.select(F.col("o_orderpriority").alias("stream_name")).distinct().union(spark.createDataFrame([("missing",)], "stream_name string"))
    return names.join(cursors, "stream_name", "left").select("stream_name", F.coalesce("last_persisted_slot", F.lit(0)).cast("long").alias("last_persisted_slot"), "last_contiguous_finalized_slot", "last_finalized_slot")


@query("SELECT o_orderkey AS id, greatest(o_custkey - o_orderkey % 1000, 0)::BIGINT AS slot_lag FROM orders")
def slot_lag(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), api.slot_lag(F.col("o_custkey"), F.col("o_orderkey") % 1000).cast("long").alias("slot_lag"))


@query(f"SELECT le, count(*) FILTER (value / 1000 <= le) AS n FROM events, (SELECT unnest([{', '.join(f'{b!r}::DOUBLE' for b in LATENCY_BOUNDS)}]) AS le) GROUP BY le")
def latency_histogram_counts(spark: SparkSession, sf: str) -> DataFrame:
    return latency_histogram(_t(spark, sf, "events").select((F.col("value") / 1000).alias("s")), "s")


# ---- decoding -------------------------------------------------------------------------------------------------------

@query(f"WITH {TB} SELECT slot, account, mint, pre_amount, post_amount, delta::BIGINT AS delta FROM td")
def token_balance_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return tb(spark, sf).select("slot", "account", "mint", "pre_amount", "post_amount", F.col("delta").cast("long").alias("delta"))


@query("""SELECT l_orderkey AS slot, count(*) FILTER (ok AND bad = 0) AS n, coalesce(sum(d) FILTER (bad = 0), 0)::BIGINT AS delta, CASE WHEN max(bad) > 0 THEN 'invalid pre' END AS error FROM (SELECT l_orderkey, true AS ok, l_quantity::BIGINT AS d, max(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS bad FROM lineitem) GROUP BY l_orderkey""")
def token_balance_deltas_from_json(spark: SparkSession, sf: str) -> DataFrame:
    li, q = _t(spark, sf, "lineitem"), F.col("l_quantity").cast("long")
    entry = F.concat(F.lit('{"account":"a","mint":"m","pre":'), F.when(F.col("l_linenumber") == 7, F.lit('"1"')).otherwise((q + 5).cast("string")), F.lit(',"post":5}'))
    payload = li.groupBy(F.col("l_orderkey").alias("slot")).agg(F.concat(F.lit('{"token_balances":['), F.array_join(F.collect_list(entry), ","), F.lit("]}")).alias("payload"))
    rows = decode.with_balances(payload)
    total = F.aggregate(F.coalesce("balances", F.array().cast(rows.schema["balances"].dataType)), F.lit(0).cast("long"), lambda s, b: s + b["pre"] - b["post"])
    return rows.select("slot", F.coalesce(F.size("balances"), F.lit(0)).cast("long").alias("n"), total.alias("delta"), F.col("decode_error").alias("error"))


@query(f"WITH {TB} {_SWAPS}")
def swap_inference(spark: SparkSession, sf: str) -> DataFrame:
    return swaps(spark, sf)


@query(f"WITH {TB} SELECT coalesce(reason, 'swap') AS reason, count(*) AS n FROM ts GROUP BY 1")
def swap_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    inferred = decode.infer_swaps(tb(spark, sf), "slot", "signature", "program_id")
    return inferred.groupBy(F.coalesce("reason", F.lit("swap")).alias("reason")).agg(F.count("*").alias("n"))


_LINES = "x AS (SELECT l_orderkey AS slot, list(l_suppkey % 5 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ps FROM lineitem GROUP BY 1)"


def _transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Updates in the nested layout: a transaction for each order, its lines as instructions; the first two again as inner ones."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    g = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("ls"))
    ins = F.transform("ls", lambda x: F.struct((x["l_suppkey"] % 5).alias("program_id_index"), F.lit(b"").alias("accounts"), F.lit(b"x").alias("data")))
    inner = F.when(F.size("ls") >= 3, F.array(F.struct(F.lit(0).cast("long").alias("index"), F.slice(ins, 1, 2).alias("instructions"))))
    key = lambda p: F.concat(F.lit(p), F.col("l_orderkey").cast("string")).cast("binary")
    message = F.struct(F.array(key("a"), key("b")).alias("account_keys"), ins.alias("instructions"))
    meta = F.struct(inner.alias("inner_instructions"), F.array(key("w")).alias("loaded_writable_addresses"), F.array(key("r")).alias("loaded_readonly_addresses"))
    t = F.struct(key("s").alias("signature"), F.lit(False).alias("is_vote"), F.col("l_orderkey").cast("decimal(20,0)").alias("index"), message.alias("message"), meta.alias("meta"))
    return g.select(F.lit("transaction").alias("kind"), F.struct(F.col("l_orderkey").cast("decimal(20,0)").alias("slot"), t.alias("transaction")).alias("transaction"))


@query(f"""WITH {_LINES}, o AS (SELECT slot, unnest(range(0, len(ps))) AS n, NULL::BIGINT AS m, ps FROM x), i AS (SELECT slot, 0 AS n, unnest(range(0, 2)) AS m, ps FROM x WHERE len(ps) >= 3)
SELECT slot, n::BIGINT AS instruction_index, m AS inner_instruction_index, ps[coalesce(m, n) + 1]::BIGINT AS program_id_index FROM (SELECT * FROM o UNION ALL SELECT * FROM i)""")
def instruction_flatten(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize.flatten_instructions(_transactions(spark, sf))
    return rows.select(F.col("transaction.slot").cast("long").alias("slot"), "instruction_index", "inner_instruction_index", F.col("ins.program_id_index").alias("program_id_index"))


@query(f"""WITH {_LINES}, o AS (SELECT slot, unnest(range(0, len(ps))) AS n, ps FROM x)
SELECT slot, n::BIGINT AS instruction_index, (['a' || slot, 'b' || slot, 'w' || slot, 'r' || slot])[ps[n + 1] + 1] AS key, ps[n + 1] > 3 AS out_of_range FROM o""")
def account_key_resolution(spark: SparkSession, sf: str) -> DataFrame:
    t = _transactions(spark, sf).withColumn("keys", normalize.account_keys("transaction.transaction"))
    rows = normalize.flatten_instructions(t).where("inner_instruction_index is null")
    key = F.get("keys", F.col("ins.program_id_index").cast("int"))
    return rows.select(F.col("transaction.slot").cast("long").alias("slot"), "instruction_index", key.cast("string").alias("key"), key.isNull().alias("out_of_range"))


@query("""WITH a AS (SELECT l_orderkey AS slot, list(DISTINCT 'acct-' || (l_suppkey % 10)) AS xs FROM lineitem GROUP BY 1) SELECT slot FROM a WHERE list_has_any(xs, ['acct-1', 'acct-2']) AND NOT list_has_any(xs, ['acct-3']) AND list_has_all(xs, ['acct-4'])""")
def transaction_account_filter(spark: SparkSession, sf: str) -> DataFrame:
    a = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("slot")).agg(F.collect_set(F.concat(F.lit("acct-"), (F.col("l_suppkey") % 10).cast("string"))).alias("xs"))
    return a.where(normalize.transaction_filter(F.col("xs"), ["acct-1", "acct-2"], ["acct-3"], ["acct-4"])).select("slot")


# ---- updates in a provider's layout ---------------------------------------------------------------------------------
# Zero bytes are ones in base58, which SQL can write too.

def _updates(df: DataFrame, kind, **parts) -> DataFrame:
    """Updates of the full schema, with the parts given."""
    shape = df.sparkSession.createDataFrame([], UPDATE).schema
    given = {"filters": F.array(F.lit("f")), "kind": kind} | parts
    return df.select("ordinal", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def _zeros(n: object) -> Column:
    return F.expr(f"cast(repeat(decode(unhex('00'), 'utf-8'), cast({n} as int)) as binary)")


@query("""SELECT o_orderkey AS ordinal, 'slot' AS kind, o_orderkey AS slot, CASE o_orderkey % 8 WHEN 0 THEN 'processed' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'finalized' WHEN 6 THEN 'dead' END AS status,
  '{"source":"live","filters":["f"],"parent":' || CASE WHEN o_custkey % 3 = 0 THEN 'null' ELSE o_custkey::VARCHAR END || ',"dead_error":' || CASE WHEN o_orderkey % 8 = 6 THEN '"x"' ELSE 'null' END || '}' AS payload,
  CASE WHEN o_orderkey % 8 IN (3, 4, 5) THEN 'unsupported slot status: ' || (o_orderkey % 8) WHEN o_orderkey % 8 = 7 THEN 'unknown slot status: 7' END AS error FROM orders""")
def update_slots(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").withColumn("ordinal", F.col("o_orderkey"))
    status = (F.col("o_orderkey") % 8).cast("int")
    slot = F.struct(F.col("o_orderkey").alias("slot"), F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("parent"), status.alias("status"), F.when(status == 6, "x").alias("dead_error"))
    rows = normalize.normalize_updates(_updates(o, F.lit("slot"), slot=slot), "c")
    return rows.select("ordinal", "kind", F.col("slot").cast("long").alias("slot"), "status", "payload", "error")


@query("""SELECT c_custkey AS ordinal, c_custkey + 5 AS slot, CASE WHEN c_custkey % 10 <> 0 THEN repeat('1', (c_custkey % 4)::INT) END AS account, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey * 2 END AS write_version,
  CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 3 = 0 THEN '11' END AS txn_signature, c_custkey % 2 = 0 AS is_startup,
  CASE WHEN c_custkey % 10 = 0 THEN '{"source":"live","filters":["f"],"lamports":null,"owner":null,"executable":null,"rent_epoch":null,"data_len":null}'
    ELSE '{"source":"live","filters":["f"],"lamports":' || c_custkey || ',"owner":"1","executable":true,"rent_epoch":9,"data_len":' || (c_custkey % 7) || '}' END AS payload,
  CASE WHEN c_custkey % 10 = 0 THEN 'missing account info' WHEN c_custkey % 4 = 0 THEN 'missing field: account' END AS error FROM customer""")
def update_accounts(spark: SparkSession, sf: str) -> DataFrame:
    k, c = F.col("c_custkey"), _t(spark, sf, "customer").withColumn("ordinal", F.col("c_custkey"))
    info = F.struct(_zeros("c_custkey % 4").alias("pubkey"), k.alias("lamports"), _zeros(1).alias("owner"), F.lit(True).alias("executable"), F.lit(9).alias("rent_epoch"), _zeros("c_custkey % 7").alias("data"), (k * 2).alias("write_version"), F.when(k % 3 == 0, _zeros(2)).alias("txn_signature"))
    account_ = F.struct((k + 5).alias("slot"), (k % 2 == 0).alias("is_startup"), F.when(k % 10 != 0, info).alias("account"))
    rows = normalize.normalize_updates(_updates(c, F.lit("account"), account=account_), "c")
    return rows.select("ordinal", F.col("slot").cast("long").alias("slot"), "account", F.col("write_version").cast("long").alias("write_version"), "txn_signature", "is_startup", "payload", "error")


@query("""SELECT s_suppkey AS ordinal, s_suppkey AS slot, CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE 'hash-' || s_suppkey END AS blockhash,
  '{"source":"live","filters":["f"],"parent_slot":' || (s_suppkey - 1) || ',"parent_blockhash":"p","executed_transaction_count":' || CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey::VARCHAR ELSE 'null' END || ',"updated_account_count":3,"entries_count":4}' AS payload,
  CASE WHEN s_suppkey % 5 = 0 THEN 'missing field: blockhash' END AS error FROM supplier""")
def update_blocks(spark: SparkSession, sf: str) -> DataFrame:
    k, s = F.col("s_suppkey"), _t(spark, sf, "supplier").withColumn("ordinal", F.col("s_suppkey"))
    block = F.struct(k.alias("slot"), F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("hash-"), k.cast("string"))).alias("blockhash"), (k - 1).alias("parent_slot"), F.lit("p").alias("parent_blockhash"), F.when(k % 2 == 0, F.col("s_nationkey")).alias("executed_transaction_count"), F.lit(3).alias("updated_account_count"), F.lit(4).alias("entries_count"))
    rows = normalize.normalize_updates(_updates(s, F.lit("block"), block=block), "c")
    return rows.select("ordinal", F.col("slot").cast("long").alias("slot"), "blockhash", "payload", "error")


@query("""SELECT p_partkey AS ordinal, p_partkey AS slot, p_partkey % 50 AS index, '{"source":"live","filters":["f"],"num_hashes":' || p_size || ',"hash":"' || repeat('1', (p_partkey % 6)::INT) || '","executed_transaction_count":2,"starting_transaction_index":null}' AS payload, NULL::VARCHAR AS error FROM part""")
def update_entries(spark: SparkSession, sf: str) -> DataFrame:
    k, p = F.col("p_partkey"), _t(spark, sf, "part").withColumn("ordinal", F.col("p_partkey"))
    entry = F.struct(k.alias("slot"), (k % 50).alias("index"), F.col("p_size").alias("num_hashes"), _zeros("p_partkey % 6").alias("hash"), F.lit(2).alias("executed_transaction_count"), F.lit(None).alias("starting_transaction_index"))
    rows = normalize.normalize_updates(_updates(p, F.lit("entry"), entry=entry), "c")
    return rows.select("ordinal", F.col("slot").cast("long").alias("slot"), F.col("index").cast("long").alias("index"), "payload", "error")


_TX = """x AS (SELECT o_orderkey AS k, o_orderkey % 6 AS n FROM orders), b AS (SELECT *, n = 5 AS bad, n = 4 AS bare FROM x),
i AS (SELECT k, unnest(range(0, n + 1)) AS pos, NULL::BIGINT AS sub FROM b WHERE NOT bad AND NOT bare UNION ALL SELECT k, 0, unnest(range(0, 2)) FROM b WHERE n = 3)"""


def _orders_as_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with none to four instructions; one kind names a program that is not there, one has no message."""
    k, o = F.col("o_orderkey"), _t(spark, sf, "orders").withColumn("ordinal", F.col("o_orderkey")).withColumn("n", F.col("o_orderkey") % 6)
    one = lambda i: F.struct(F.when(F.col("n") == 5, 9).otherwise(i % 2).cast("long").alias("program_id_index"), F.expr("unhex('0aff')").alias("accounts"), _zeros(2).alias("data"))
    message = F.struct(F.array(_zeros(3)).alias("account_keys"), F.transform(F.sequence(F.lit(0).cast("long"), F.col("n")), one).alias("instructions"))
    meta = F.struct(F.when(F.col("n") == 3, F.array(F.struct(F.lit(0).cast("long").alias("index"), F.transform(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")), one).alias("instructions")))).alias("inner_instructions"), F.array(_zeros(4)).alias("loaded_writable_addresses"), F.array().cast("array<binary>").alias("loaded_readonly_addresses"))
    t = F.struct(_zeros("o_orderkey % 5 + 1").alias("signature"), (k % 2 == 0).alias("is_vote"), (k % 100).alias("index"), F.when(F.col("n") != 4, message).alias("message"), meta.alias("meta"))
    return _updates(o, F.lit("transaction"), transaction=F.struct(k.alias("slot"), t.alias("transaction")))


@query(f"""WITH {_TX} SELECT k AS ordinal, 'transaction' AS kind, k AS slot, repeat('1', (k % 5 + 1)::INT) AS signature, k % 100 AS index, '{{"source":"live","filters":["f"],"is_vote":' || (k % 2 = 0) || '}}' AS payload, CASE WHEN bad THEN 'program id index out of range' END AS error FROM b""")
def update_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize.normalize_updates(_orders_as_transactions(spark, sf), "c").where("kind = 'transaction'")
    return rows.select("ordinal", "kind", F.col("slot").cast("long").alias("slot"), "signature", F.col("index").cast("long").alias("index"), "payload", "error")


@query(f"""WITH {_TX}, p AS (SELECT *, coalesce(sub, pos) % 2 AS x FROM i)
SELECT k AS ordinal, k % 100 AS transaction_index, pos AS instruction_index, sub AS inner_instruction_index, repeat('1', (3 + x)::INT) AS program_id,
  '{{"source":"live","filters":["f"],"program_id_index":' || x || ',"program_id":"' || repeat('1', (3 + x)::INT) || '","accounts":[10,255],"data":"11"}}' AS payload, NULL::VARCHAR AS error FROM p""")
def update_instructions(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize.normalize_updates(_orders_as_transactions(spark, sf), "c").where("kind = 'instruction'")
    longs = [F.col(n).cast("long").alias(n) for n in ("transaction_index", "instruction_index", "inner_instruction_index")]
    return rows.select("ordinal", *longs, "program_id", "payload", "error")


@query("""SELECT CASE event_id % 8 WHEN 0 THEN 'slot' WHEN 1 THEN 'block' WHEN 2 THEN 'entry' WHEN 3 THEN 'account' ELSE 'unknown' END AS kind,
  CASE WHEN event_id % 8 = 3 THEN 'missing account info' WHEN event_id % 8 IN (6, 7) THEN 'missing update' END AS error, count(*) AS n FROM events WHERE event_id % 8 NOT IN (4, 5) GROUP BY 1, 2""")
def update_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Updates of all kinds in one stream: some have no event, some are of no kind."""
    i, e = F.col("event_id"), _t(spark, sf, "events").withColumn("ordinal", F.col("event_id"))
    kind = F.element_at(F.array(*map(F.lit, ("slot", "block", "entry", "account", "ping", "block_meta", "other", None))), (i % 8 + 1).cast("int"))
    slot = F.struct(i.alias("slot"), F.lit(None).alias("parent"), F.lit(2).alias("status"), F.lit(None).alias("dead_error"))
    block = F.struct(i.alias("slot"), F.lit("h").alias("blockhash"), *[F.lit(None).alias(n) for n in ("parent_slot", "parent_blockhash", "executed_transaction_count", "updated_account_count", "entries_count")])
    entry = F.struct(i.alias("slot"), i.alias("index"), *[F.lit(None).alias(n) for n in ("num_hashes", "hash", "executed_transaction_count", "starting_transaction_index")])
    account_ = F.struct(i.alias("slot"), F.lit(False).alias("is_startup"), F.lit(None).alias("account"))
    rows = normalize.normalize_updates(_updates(e, kind, slot=slot, block=block, entry=entry, account=account_), "c")
    return rows.groupBy("kind", "error").agg(F.count("*").alias("n"))


# ---- counters of ingestion ------------------------------------------------------------------------------------------

@query("SELECT event_id AS ordinal, event_id % 4 = 0 AS skipped, CASE WHEN event_id % 4 <> 0 THEN event_id END AS slot FROM events")
def conversion_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Slots beyond the signed 64-bit range are left out of what is stored, and nothing else."""
    i = F.col("event_id").cast("decimal(20,0)")
    rows = _t(spark, sf, "events").select(F.col("event_id").alias("ordinal"), F.when(F.col("event_id") % 4 == 0, i + F.lit("9223372036854775808").cast("decimal(20,0)")).otherwise(i).cast("decimal(20,0)").alias("slot"))
    stored = dedup.convertible(rows)
    return rows.select("ordinal").join(stored, "ordinal", "left").select("ordinal", F.col("slot").isNull().alias("skipped"), "slot")


@query("SELECT count(*) AS attempted, 0::BIGINT AS inserted, 0::BIGINT AS deduplicated, count(*) AS skipped FROM events")
def nothing_convertible(spark: SparkSession, sf: str) -> DataFrame:
    rows = ev(spark, sf).select(event_id().alias("event_id"), (F.col("slot") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)").alias("slot"))
    return dedup.write_summary(rows)


def _told(spark: SparkSession, done: pipeline.Summary) -> DataFrame:
    names = ("events_seen", "events_skipped", "batches_written", "events_attempted", "events_inserted", "events_deduplicated", "last_persisted_slot")
    return spark.createDataFrame([tuple(getattr(done, n) for n in names)], ", ".join(f"{n} long" for n in names))


@query(f"""WITH {EV}, a AS (SELECT * FROM ei WHERE slot <= 20), n AS (SELECT * FROM ei WHERE slot > 20), t AS (SELECT count(*) AS n, count(DISTINCT eid) AS d, max(slot)::BIGINT AS top FROM n)
SELECT (SELECT count(*) FROM ei) AS events_seen, (SELECT count(*) FROM a) AS events_skipped, ceil(n / 500)::BIGINT AS batches_written, n AS events_attempted, d AS events_inserted, n - d AS events_deduplicated, top AS last_persisted_slot FROM t""")
def replay_counters(spark: SparkSession, sf: str) -> DataFrame:
    """A replay after a first part has been stored: counters by batches of 500 in commits of 4,000 rows."""
    tables = Tables(spark, _scratch(spark, "counters"))
    rows = ev(spark, sf)
    pipeline.replay(tables, rows.where("slot <= 20"), "s")
    return _told(spark, pipeline.replay(tables, rows, "s", commit_rows=4000))


@query(f"WITH {TB} {_SWAPS}")
def stored_swaps(spark: SparkSession, sf: str) -> DataFrame:
    """Events with token balances, ingested; the swaps that were stored on the way."""
    entry = F.to_json(F.struct("account", "mint", F.col("pre_amount").alias("pre"), F.col("post_amount").alias("post")))
    keys = ("slot", "signature", "program_id")
    grouped = tb(spark, sf).groupBy(*keys).agg(F.concat(F.lit('{"token_balances":['), F.array_join(F.collect_list(entry), ","), F.lit("]}")).alias("payload"))
    zero = F.lit(0)
    rows = wide(grouped.select(F.lit("instruction").alias("kind"), F.lit("c").alias("cluster"), *keys, zero.alias("transaction_index"), zero.alias("instruction_index"), "payload", F.col("slot").alias("ordinal")))
    tables = Tables(spark, _scratch(spark, "swaps"))
    pipeline.replay(tables, rows, "s")
    return tables.read("swaps").select(*keys, "token_in", "token_in_amount", "token_out", "token_out_amount")


# ---- generator and streams ------------------------------------------------------------------------------------------

@query("""WITH g AS (SELECT i, i // 100 + 1 AS slot, i % 100 AS n, 'sig-' || printf('%016x', i // 100 + 1) || '-' || printf('%08x', i) AS sig FROM (SELECT event_id AS i FROM events)),
k AS (SELECT *, CASE WHEN i % 4 = 1 THEN 'instruction' WHEN i % 4 = 2 THEN 'account' WHEN i % 4 = 3 AND n = 99 THEN 'slot' ELSE 'transaction' END AS kind FROM g)
SELECT i AS ordinal, kind, slot, CASE WHEN kind <> 'slot' THEN sig END AS signature, CASE WHEN kind = 'account' THEN 'acct-' || printf('%016x', slot) || '-' || printf('%04x', n) END AS account,
  CASE WHEN kind = 'instruction' THEN ['11111111111111111111111111111111', 'TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA', 'ATokenGPvbdGVxr1b2hvZbsiqW5xWH25efTNsLJA8knL'][i % 3 + 1] END AS program_id, '{"index":' || i || '}' AS payload FROM k""")
def synthetic_generator(spark: SparkSession, sf: str) -> DataFrame:
    """The generator's rule on the numbers of the events table."""
    g = events_by_rule(_t(spark, sf, "events").select(F.col("event_id").alias("ordinal"), F.col("event_id").alias("i")))
    return g.select("ordinal", "kind", F.col("slot").cast("long").alias("slot"), signature().alias("signature"), account().alias("account"), program_id().alias("program_id"), "payload")


@query("SELECT i AS ordinal, i // 100 + 1 AS slot, NULL::VARCHAR AS parse_error FROM (SELECT event_id AS i FROM events)")
def generator_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Generated events written as replay lines and parsed again."""
    g = events_by_rule(_t(spark, sf, "events").select(F.col("event_id").alias("ordinal"), F.col("event_id").alias("i")))
    return parse_lines(to_jsonl(g, "ordinal")).select("ordinal", F.col("slot").cast("long").alias("slot"), "parse_error")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors share one, deleted when the application ends."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def _saved(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = _scratch(spark, "saved")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: About the most rows of a file that is dropped, and of a micro-batch (files are cut by hash, batches by ranges of ordinals).
FILE_ROWS, BATCH_ROWS = 125_000, 2_000_000


def _dropped(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """The rows as files in the order of their ordinals, three batches or more, one after the other, as they arrive; the number of files of a batch.

    A batch has as many files as its rows ask for, so the rows of a task or a batch do not grow with the table.
    """
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("ordinal"), F.max("ordinal")).first()
    batches = max(3, -(-n // BATCH_ROWS))
    files = max(1, -(-n // (batches * FILE_ROWS)))
    part = F.floor((F.col("ordinal") - F.lit(low)) * batches / F.lit((high or 0) - (low or 0) + 1))
    laid_at = _scratch(spark, "laid")
    # By hash into 200 partitions at most, which Spark writes without sorting or holding rows; each has some files' rows.
    rows.withColumn("_batch", part.cast("int")).repartition(min(200, batches * files), "_batch", F.col("ordinal") % files).write.partitionBy("_batch").parquet(laid_at)
    laid = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(laid_at)
    for k in range(batches):
        laid.where(F.col("_batch") == k).drop("_batch").repartition(files, "ordinal").write.mode("append").parquet(path)
    return files


def _streamed(spark: SparkSession, sf: str, rows: DataFrame, frontier: bool) -> Tables:
    """Drop the rows as files, and ingest them as a stream, a batch of files at a time."""
    from ..streaming.ingest import Ingest

    root = _scratch(spark, "stream")
    files = _dropped(spark, rows, f"{root}/drop")
    tables = Tables(spark, f"{root}/tables")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/drop")
    Ingest(tables, "s", frontier).run(stream, f"{root}/checkpoint")
    return tables


@query(f"WITH {EV} SELECT DISTINCT eid AS event_id, slot::BIGINT AS slot FROM ei")
def streaming_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, ev(spark, sf), False).read("events").select("event_id", "slot")


@query("SELECT 's' AS stream_name, max(event_id // 100 + 1)::BIGINT AS last_persisted_slot FROM events")
def streaming_cursor(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, ev(spark, sf), False).read("stream_cursors").select("stream_name", "last_persisted_slot")


_FRONTIER_SQL = """WITH RECURSIVE f AS (SELECT o_orderkey AS slot, max(o_orderkey) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent_slot FROM orders WHERE o_orderstatus = 'F'), fin AS (SELECT * FROM f WHERE slot % 1000 <> 7),
r AS (SELECT min(slot) AS slot FROM fin UNION ALL SELECT fin.slot FROM r JOIN fin ON fin.parent_slot = r.slot AND fin.slot > r.slot)
SELECT 's' AS stream_name, (SELECT max(slot) FROM fin)::BIGINT AS last_persisted_slot, max(slot) AS last_contiguous_finalized_slot, (SELECT max(slot) FROM fin) AS last_finalized_slot FROM r"""


def _linked_slots(spark: SparkSession, sf: str) -> DataFrame:
    f = _t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("slot"))
    # Links within ranges of keys, then the last key of each range below: no global window over the table.
    ranged = f.withColumn("r", F.floor(F.col("slot") / 10_000))
    tops = ranged.groupBy("r").agg(F.max("slot").alias("top")).withColumn("below", F.max("top").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1))).select("r", "below")
    linked = ranged.withColumn("p", F.lag("slot").over(Window.partitionBy("r").orderBy("slot"))).join(tops, "r").select("slot", F.coalesce("p", "below").alias("p")).where("slot % 1000 <> 7")
    payload = F.when(F.col("p").isNotNull(), F.concat(F.lit('{"parent":'), F.col("p").cast("string"), F.lit("}"))).otherwise("{}")
    rows = wide(linked.select(F.col("slot").alias("ordinal"), F.lit("slot").alias("kind"), F.lit("c").alias("cluster"), "slot", F.lit("finalized").alias("status"), payload.alias("payload")))
    return rows


@query(_FRONTIER_SQL)
def streaming_frontier(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, _linked_slots(spark, sf), True).read("stream_cursors").select("stream_name", "last_persisted_slot", "last_contiguous_finalized_slot", "last_finalized_slot")


@query(_FRONTIER_SQL)
def streaming_markers(spark: SparkSession, sf: str) -> DataFrame:
    """The same markers from the keyed state of a query over files that arrive one after the other."""
    from ..streaming import state

    root, rows = _scratch(spark, "state"), _linked_slots(spark, sf)
    files = _dropped(spark, rows, f"{root}/drop")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/drop")
    before = spark.conf.get(state.STORE[0])
    state.use_store(spark)
    try:
        save = lambda df, batch: df.write.mode("append").parquet(f"{root}/told")
        state.markers(stream, "s").writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(state.STORE[0], before)
    told = spark.read.schema(state.MARKERS).parquet(f"{root}/told")
    return told.groupBy("stream_name").agg(*[F.max(c).alias(c) for c in ("last_persisted_slot", "last_contiguous_finalized_slot", "last_finalized_slot")])
