"""Live subscription: the request, and a streaming source over a pluggable transport."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

KINDS = ("slots", "transactions", "blocks", "entries")
COMMITMENTS = ("processed", "confirmed", "finalized")


@dataclass(frozen=True)
class Subscription:
    """What is asked of the provider. Accounts are never subscribed to by themselves."""

    kinds: tuple[str, ...] = ("slots",)
    commitment: str = "processed"
    from_slot: int | None = None
    account_include: tuple[str, ...] = ()
    account_exclude: tuple[str, ...] = ()
    account_required: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.kinds:
            raise ValueError("at least one subscription kind is needed")
        if unknown := set(self.kinds) - set(KINDS):
            raise ValueError(f"unknown subscription kinds: {sorted(unknown)}")
        if self.commitment not in COMMITMENTS:
            raise ValueError(f"unknown commitment: {self.commitment}")
        for name in ("account_include", "account_exclude", "account_required"):
            if any(not a.strip() for a in getattr(self, name)):
                raise ValueError(f"{name} has an empty account")
        if (self.account_include or self.account_exclude or self.account_required) and "transactions" not in self.kinds:
            raise ValueError("account filters need the transactions subscription")

    def request(self) -> dict:
        out: dict = {"commitment": self.commitment, "accounts": {}}
        if "slots" in self.kinds:
            out["slots"] = {"filter_by_commitment": False, "interslot_updates": False}
        if "transactions" in self.kinds:
            out["transactions"] = {"vote": False, "account_include": list(self.account_include), "account_exclude": list(self.account_exclude), "account_required": list(self.account_required)}
        if "blocks" in self.kinds:
            out["blocks"] = {"include_transactions": False, "include_accounts": False, "include_entries": False}
        if "entries" in self.kinds:
            out["entries"] = {}
        if self.from_slot is not None:
            out["from_slot"] = self.from_slot
        return out

    def with_from_slot(self, slot: int | None) -> Subscription:
        return Subscription(self.kinds, self.commitment, slot, self.account_include, self.account_exclude, self.account_required)


#: Transports by name: each takes the request and the last offset and yields update rows as JSON text.
TRANSPORTS: dict[str, Callable[[dict, int], Iterator[str]]] = {}


LINES_PER_TASK = 1000


@dataclass
class _Range(InputPartition):
    start: int
    end: int
    lines: list[str] = field(default_factory=list)


class LiveReader(DataSourceStreamReader):
    """Micro-batches of updates by position; at most ``max_per_batch`` are taken at once, which is the backpressure."""

    def __init__(self, options: dict):
        self.request = json.loads(options.get("request", "{}"))
        self.transport = options["transport"]
        self.limit = int(options.get("max_per_batch", "10000"))
        self.held: dict[int, str] = {}
        self.at = 0
        self.feed: Iterator[str] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"position": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.feed is None:
            self.feed = TRANSPORTS[self.transport](self.request, self.at)
        for _ in range(self.limit):
            line = next(self.feed, None)
            if line is None:
                break
            self.held[self.at] = line
            self.at += 1
        return {"position": self.at}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        missing = [p for p in range(start["position"], end["position"]) if p not in self.held]
        if missing:  # after a restart the transport is asked again from the last committed position
            feed = TRANSPORTS[self.transport](self.request, start["position"])
            for p in range(start["position"], end["position"]):
                line = next(feed, None)
                if line is None:
                    raise RuntimeError("the transport no longer holds updates that were not committed")
                self.held[p] = line
            self.at = max(self.at, end["position"])
        edges = [*range(start["position"], end["position"], LINES_PER_TASK), end["position"]]
        return [_Range(a, b, [self.held[p] for p in range(a, b)]) for a, b in zip(edges, edges[1:], strict=False)]

    def read(self, partition: _Range):
        for i, line in enumerate(partition.lines):
            yield (partition.start + i, line)

    def commit(self, end: dict) -> None:
        for p in [p for p in self.held if p < end["position"]]:
            del self.held[p]


class LiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_live"

    def schema(self) -> str:
        return "ordinal long, value string"

    def streamReader(self, schema) -> LiveReader:  # noqa: N802
        return LiveReader(dict(self.options))
