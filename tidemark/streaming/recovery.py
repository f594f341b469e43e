"""Reconnection: backoff, classification of errors, the loop, and the recovery state."""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass, field


class SourceError(Exception):
    """``kind`` as classified by ``retryable``; ``code`` is the provider's status code, if any."""

    def __init__(self, kind: str, message: str = "", code: str | None = None):
        super().__init__(message or kind)
        self.kind, self.code = kind, code


FATAL_CODES = ("invalid_argument", "unauthenticated", "permission_denied")


def retryable(error: SourceError) -> bool:
    if error.kind in ("connect", "stream_closed"):
        return True
    return error.kind in ("subscribe", "receive") and error.code not in FATAL_CODES


@dataclass(frozen=True)
class Backoff:
    """Delays in milliseconds; zeros count as one, and the largest delay is at least the first."""

    initial: int = 1000
    maximum: int = 30_000
    reset_after: int = 30_000
    max_attempts: int | None = None

    def normalized(self) -> Backoff:
        first = max(1, self.initial)
        return Backoff(first, max(first, self.maximum), max(1, self.reset_after), self.max_attempts)

    def following(self, delay: int, jitter: Callable[[int], int] | None = None) -> int:
        """Twice the delay plus up to the delay again, up to the largest."""
        extra = (jitter or (lambda n: random.randrange(n) if n else 0))(delay)
        return min(2 * delay + extra, self.maximum)


def reconnect_loop(attempt: Callable[[int], None], backoff: Backoff, sleep: Callable[[int], None], clock: Callable[[], int], on_reconnect: Callable[[int, int, SourceError], None] | None = None, jitter: Callable[[int], int] | None = None) -> None:
    """Call ``attempt`` until it returns or fails for good. A long attempt resets the count and the delay; the delay grows before each sleep."""
    rule = backoff.normalized()
    count, delay = 0, rule.initial
    while True:
        began = clock()
        try:
            return attempt(count)
        except SourceError as error:
            if not retryable(error):
                raise
            if clock() - began >= rule.reset_after:
                count, delay = 0, rule.initial
            count += 1
            if rule.max_attempts and count > rule.max_attempts:
                raise
            delay = rule.following(delay, jitter)
            if on_reconnect:
                on_reconnect(count, delay, error)
            sleep(delay)


@dataclass
class LiveStatus:
    """Recovery as seen from outside. Resuming without a slot risks a gap; running again does not clear that risk."""

    producer_state: str = "running"
    recovery_state: str = "steady"
    reconnect_attempts: int = 0
    last_reconnect_delay_ms: int | None = None
    last_reconnect_from_slot: int | None = None
    gap_risk_count: int = 0
    last_error_kind: str | None = None
    last_error: str | None = None
    last_event_at_unix_ms: int | None = None
    last_observed_at_unix_ms: int | None = None
    last_observed_slot: int | None = None
    last_persisted_batch_at_unix_ms: int | None = None
    decode_errors_total: int = 0

    def reconnecting(self, attempt: int, delay_ms: int, from_slot: int | None, error: SourceError) -> None:
        self.producer_state, self.reconnect_attempts, self.last_reconnect_delay_ms, self.last_reconnect_from_slot = "reconnecting", self.reconnect_attempts + 1, delay_ms, from_slot
        self.last_error_kind, self.last_error = error.kind, str(error)
        self.recovery_state = "reconnecting" if from_slot is not None else "gap_risk"
        self.gap_risk_count += from_slot is None

    def running(self) -> None:
        self.producer_state = "running"
        if self.recovery_state == "reconnecting":
            self.recovery_state = "steady"

    def observed(self, slot: int, now_ms: int) -> None:
        self.last_event_at_unix_ms = self.last_observed_at_unix_ms = now_ms
        self.last_observed_slot = slot

    def persisted(self, now_ms: int) -> None:
        self.last_persisted_batch_at_unix_ms = now_ms

    def snapshot(self, now_ms: int, persisted_slot: int | None) -> dict:
        """All fields, with staleness and lag as of now."""
        since = lambda t: None if t is None else max(0, now_ms - t) // 1000
        lag = None if self.last_observed_slot is None or persisted_slot is None else max(0, self.last_observed_slot - persisted_slot)
        return {k: v for k, v in vars(self).items()} | {"seconds_since_last_event": since(self.last_event_at_unix_ms), "seconds_since_last_persisted_batch": since(self.last_persisted_batch_at_unix_ms), "observed_to_persisted_slot_lag": lag}


@dataclass
class Throttle:
    """Lets an update through at most once in ``every`` milliseconds."""

    every: int = 1000
    last: int | None = field(default=None)

    def ready(self, now_ms: int) -> bool:
        if self.last is not None and now_ms - self.last < self.every:
            return False
        self.last = now_ms
        return True
