"""Raw typed events and nested source updates to wide envelope rows with ``error`` (null for a good row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base58 import base58_array
from ..functions.identity import blank, invalid_field, wide
from ..schema import EVENT, STATUSES

#: Required text of each raw kind, checked before the identity.
REQUIRED = {"transaction": ("signature",), "account": ("account",), "instruction": ("signature", "program_id"), "block": ("blockhash",)}
#: The provider's numbers of slot statuses. Others up to 6 are known but carry no event.
SLOT_STATUS = {0: "processed", 1: "confirmed", 2: "finalized", 6: "dead"}
UNSUPPORTED_STATUS = (3, 4, 5)


def normalize(raw: DataFrame) -> DataFrame:
    """Raw rows of any kind (``kind`` and that kind's fields) to envelope rows with ``error``."""
    rows = wide(raw)
    missing = reduce(
        lambda w, kv: w.when(F.col("kind") == kv[0], F.coalesce(*[F.when(F.col(n).isNull() | blank(F.col(n)), F.lit(n)) for n in kv[1]])),
        REQUIRED.items(),
        F.when(F.lit(False), F.lit("")),
    )
    empty_txn = (F.col("kind") == "account") & F.col("txn_signature").isNotNull() & blank(F.col("txn_signature"))
    status = (F.col("kind") == "slot") & ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    error = (
        F.when(missing.isNotNull(), F.concat(F.lit("missing field: "), missing))
        .when(empty_txn, "missing field: txn_signature")
        .when(status, F.concat(F.lit("invalid slot status: "), F.coalesce("status", F.lit("null"))))
        .when(invalid_field().isNotNull(), F.concat(F.lit("invalid identity: "), invalid_field()))
    )
    return rows.withColumn("error", error)


def account_keys(transaction: str) -> Column:
    """Static keys, then loaded writable ones, then loaded read-only ones."""
    none = F.array().cast("array<binary>")
    return F.concat(*[F.coalesce(F.col(f"{transaction}.{p}"), none) for p in ("message.account_keys", "meta.loaded_writable_addresses", "meta.loaded_readonly_addresses")])


def flatten_instructions(updates: DataFrame, t: str = "transaction.transaction") -> DataFrame:
    """One row for each outer and inner instruction: transaction_index, instruction_index, inner_instruction_index, program and data.

    An inner group carries the index of its outer instruction; places within a group are positional. Nothing is flattened
    without message.
    """
    base = updates.where(F.col(f"{t}.message").isNotNull())
    keep = [c for c in updates.columns]
    outer = base.select(*keep, F.posexplode(f"{t}.message.instructions").alias("instruction_index", "ins")).select(*keep, F.col("instruction_index").cast("long").alias("instruction_index"), F.lit(None).cast("long").alias("inner_instruction_index"), "ins")
    groups = base.select(*keep, F.explode(f"{t}.meta.inner_instructions").alias("g"))
    inner = groups.select(*keep, F.col("g.index").alias("instruction_index"), F.posexplode("g.instructions").alias("inner_instruction_index", "ins")).select(*keep, "instruction_index", F.col("inner_instruction_index").cast("long").alias("inner_instruction_index"), "ins")
    return outer.unionByName(inner)


_INSTRUCTIONS = "array<struct<program_id_index: bigint, accounts: binary, data: binary>>"
_GROUPS = f"array<struct<index: bigint, instructions: {_INSTRUCTIONS}>>"


def _row(kind: str, cluster: str, error: Column | None, payload: list[Column], **fields: Column) -> Column:
    """One envelope row as a struct; all kinds have the same type."""
    fields |= {"kind": F.lit(kind), "cluster": F.lit(cluster), "payload": F.to_json(F.struct(F.lit("live").alias("source"), "filters", *payload), {"ignoreNullFields": "false"})}
    typed = [(fields[f.name] if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields]
    return F.struct(*typed, (F.lit(None) if error is None else error).cast("string").alias("_update_error"))


def _instructions(t: str = "transaction.transaction") -> Column:
    """Outer and inner instructions with their places (``at``, ``inner``, ``ins``); null without message."""
    outer = F.transform(F.coalesce(f"{t}.message.instructions", F.array().cast(_INSTRUCTIONS)), lambda x, i: F.struct(i.cast("long").alias("at"), F.lit(None).cast("long").alias("inner"), x.alias("ins")))
    groups = F.coalesce(f"{t}.meta.inner_instructions", F.array().cast(_GROUPS))
    inner = F.flatten(F.transform(groups, lambda g: F.transform(g["instructions"], lambda x, i: F.struct(g["index"].alias("at"), i.cast("long").alias("inner"), x.alias("ins")))))
    return F.when(F.col(f"{t}.message").isNotNull(), F.concat(outer, inner))


def normalize_updates(updates: DataFrame, cluster: str) -> DataFrame:
    """Nested source updates (schema ``UPDATE``) to envelope rows with ``error``, in one pass over the source.

    Kinds without an event (ping, pong, block_meta, transaction_status) give no row; an update of no kind gives an error
    row. One instruction whose program index is out of range spoils all rows of its transaction.
    """
    t, kind = "transaction.transaction", F.col("kind")
    keep = ["ordinal"] if "ordinal" in updates.columns else []
    binary = F.array(*[F.col(c) for c in ("account.account.owner", "account.account.pubkey", "account.account.txn_signature", "entry.hash", f"{t}.signature")])
    own = updates.withColumn("_ins", F.when(kind == "transaction", _instructions(t)))
    own = own.withColumn("_text", base58_array(binary)).withColumn("_keys", base58_array(F.when(kind == "transaction", account_keys(t)))).withColumn("_data", base58_array(F.transform("_ins", lambda i: i["ins"]["data"])))
    owner, pubkey, txn_signature, entry_hash, sig = (F.get("_text", F.lit(i)) for i in range(5))
    none = F.array().cast("array<int>")
    bytes_ = lambda c: F.when(F.octet_length(c) > 0, F.transform(F.sequence(F.lit(1), F.octet_length(c)), lambda k: F.conv(F.hex(F.substring(c, k, F.lit(1))), 16, 10).cast("int"))).otherwise(none)
    names = lambda of, *ns: [F.col(f"{of}.{n}").alias(n) for n in ns]
    status = F.col("slot.status")
    known = reduce(lambda w, kv: w.when(status == kv[0], kv[1]), SLOT_STATUS.items(), F.when(F.lit(False), F.lit("")))
    bad_status = F.when(status.isin(*UNSUPPORTED_STATUS), F.concat(F.lit("unsupported slot status: "), status.cast("string"))).when(known.isNull(), F.concat(F.lit("unknown slot status: "), F.coalesce(status.cast("string"), F.lit("null"))))
    out_of_range = F.exists("_ins", lambda i: (i["ins"]["program_id_index"] < 0) | (i["ins"]["program_id_index"] >= F.size("_keys")))
    bad = F.when(F.col(t).isNull(), "missing transaction info").when(F.coalesce(out_of_range, F.lit(False)), "program id index out of range")

    def instruction(i: Column, k: Column) -> Column:
        program = F.get("_keys", i["ins"]["program_id_index"].cast("int"))
        fits = (i["at"] <= 65535) & (F.coalesce(i["inner"], F.lit(0)) <= 65535)
        payload = [i["ins"]["program_id_index"].alias("program_id_index"), program.alias("program_id"), bytes_(i["ins"]["accounts"]).alias("accounts"), F.get("_data", k).alias("data")]
        return _row("instruction", cluster, F.when(~fits, "instruction index out of range"), payload, slot=F.col("transaction.slot"), signature=sig, transaction_index=F.col(f"{t}.index"), instruction_index=i["at"], inner_instruction_index=i["inner"], program_id=program)

    account = _row(
        "account", cluster, F.when(F.col("account.account").isNull(), "missing account info"),
        [F.col("account.account.lamports").alias("lamports"), owner.alias("owner"), *names("account.account", "executable", "rent_epoch"), F.octet_length("account.account.data").alias("data_len")],
        slot=F.col("account.slot"), account=pubkey, write_version=F.col("account.account.write_version"), txn_signature=txn_signature, is_startup=F.col("account.is_startup"),
    )
    slot = _row("slot", cluster, bad_status, names("slot", "parent", "dead_error"), slot=F.col("slot.slot"), status=known)
    block = _row("block", cluster, None, names("block", "parent_slot", "parent_blockhash", "executed_transaction_count", "updated_account_count", "entries_count"), slot=F.col("block.slot"), blockhash=F.col("block.blockhash"))
    entry = _row("entry", cluster, None, [*names("entry", "num_hashes"), entry_hash.alias("hash"), *names("entry", "executed_transaction_count", "starting_transaction_index")], slot=F.col("entry.slot"), index=F.col("entry.index"))
    transaction = F.array(_row("transaction", cluster, bad, names(t, "is_vote"), slot=F.col("transaction.slot"), signature=sig, index=F.col(f"{t}.index")))
    flat = F.when(bad.isNull() & F.col("_ins").isNotNull(), F.concat(transaction, F.transform("_ins", instruction))).otherwise(transaction)
    nothing = F.filter(transaction, lambda _: F.lit(False))
    rows = F.when(kind == "account", F.array(account)).when(kind == "slot", F.array(slot)).when(kind == "block", F.array(block)).when(kind == "entry", F.array(entry)).when(kind == "transaction", flat)
    rows = rows.when(kind.isin("ping", "pong", "block_meta", "transaction_status"), nothing).otherwise(F.array(_row("unknown", cluster, F.lit("missing update"), [])))
    checked = normalize(own.select(*keep, F.explode(rows).alias("_r")).select("_r.*", *keep))
    return checked.withColumn("error", F.coalesce("_update_error", "error")).drop("_update_error")


def transaction_filter(accounts: Column, include: list[str] = (), exclude: list[str] = (), required: list[str] = ()) -> Column:
    """The provider's account filter: any of ``include`` (if given), none of ``exclude``, all of ``required``."""
    lit = lambda xs: F.array(*map(F.lit, xs))
    out = F.lit(True)
    if include:
        out = out & F.arrays_overlap(accounts, lit(include))
    if exclude:
        out = out & ~F.arrays_overlap(accounts, lit(exclude))
    if required:
        out = out & (F.size(F.array_except(lit(required), accounts)) == 0)
    return out
