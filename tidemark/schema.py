"""Schemas of the typed envelope, the stored tables and the raw inputs.

Unsigned 64-bit numbers are parsed as DECIMAL(20,0) and stored as LONG; what does not fit is skipped by the writer.
"""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = ("account", "block", "entry", "instruction", "slot", "transaction")
STATUSES = ("processed", "confirmed", "finalized", "dead")
U64 = T.DecimalType(20, 0)
MAX_LONG = 2**63 - 1
SLOTS_PER_BUCKET = 10_000  # of the tables' layout

#: Identity fields of each kind in key order: name, type, whether it may be missing.
IDENTITY_FIELDS: dict[str, tuple[tuple[str, str, bool], ...]] = {
    "account": (("account", "string", False), ("write_version", "u64", False), ("txn_signature", "string", True), ("is_startup", "bool", False)),
    "block": (("blockhash", "string", False),),
    "entry": (("index", "u64", False),),
    "instruction": (("signature", "string", False), ("transaction_index", "u64", False), ("instruction_index", "u16", False), ("inner_instruction_index", "u16", True), ("program_id", "string", False)),
    "slot": (("status", "string", False),),
    "transaction": (("signature", "string", False), ("index", "u64", False)),
}
_TYPES = {"string": T.StringType(), "u64": U64, "u16": T.IntegerType(), "bool": T.BooleanType()}
#: One wide nullable row for all kinds.
IDENTITY = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("cluster", T.StringType()), T.StructField("slot", U64)]
    + [T.StructField(n, _TYPES[t]) for n, t in dict((n, t) for fields in IDENTITY_FIELDS.values() for n, t, _ in fields).items()]
)
EVENT = T.StructType(IDENTITY.fields + [T.StructField("payload", T.StringType())])


def _flat(fields: str) -> T.StructType:
    """A schema of plain types; unlike a DDL parse it needs no session."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "short": T.ShortType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split() for f in fields.split(", "))])


EVENTS = _flat(
    "event_id string, identity_version short, identity string, slot long, signature string, program_id string, account string, event_type string, payload string, observed_at timestamp, inserted_at timestamp"
)
STREAM_CURSORS = _flat("stream_name string, last_persisted_slot long, last_contiguous_finalized_slot long, last_finalized_slot long, updated_at timestamp, metadata string")
INGESTION_RUNS = _flat("run_id string, started_at timestamp, stopped_at timestamp, status string, git_sha string, config_hash string")
STREAM_SLOTS = _flat("stream_name string, slot long, parent_slot long, finalized boolean, dead boolean, first_seen_at timestamp")
SWAPS = _flat("slot long, signature string, program_id string, token_in string, token_in_amount long, token_out string, token_out_amount long, inferred_at timestamp")
DEAD_LETTERS = _flat("stream_name string, source string, line_number long, reason string, line string, seen_at timestamp")

#: Nested source updates, as a provider's messages lay them out (DDL).
_INSTRUCTION = "struct<program_id_index: long, accounts: binary, data: binary>"
UPDATE = (
    "filters array<string>, kind string,"
    " account struct<slot: decimal(20,0), is_startup: boolean, account: struct<pubkey: binary, lamports: decimal(20,0), owner: binary, executable: boolean, rent_epoch: decimal(20,0), data: binary, write_version: decimal(20,0), txn_signature: binary>>,"
    " slot struct<slot: decimal(20,0), parent: decimal(20,0), status: int, dead_error: string>,"
    f" transaction struct<slot: decimal(20,0), transaction: struct<signature: binary, is_vote: boolean, index: decimal(20,0), message: struct<account_keys: array<binary>, instructions: array<{_INSTRUCTION}>>,"
    f" meta: struct<inner_instructions: array<struct<index: long, instructions: array<{_INSTRUCTION}>>>, loaded_writable_addresses: array<binary>, loaded_readonly_addresses: array<binary>>>>,"
    " block struct<slot: decimal(20,0), blockhash: string, parent_slot: decimal(20,0), parent_blockhash: string, executed_transaction_count: decimal(20,0), updated_account_count: decimal(20,0), entries_count: decimal(20,0)>,"
    " entry struct<slot: decimal(20,0), index: decimal(20,0), num_hashes: decimal(20,0), hash: binary, executed_transaction_count: decimal(20,0), starting_transaction_index: decimal(20,0)>"
)
