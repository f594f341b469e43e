"""Configuration from environment and arguments, validated in a fixed order; secrets never show."""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from .sources.live import KINDS

EXIT_CODES = {"config": 2, "telemetry": 2, "replay": 3, "storage": 4, "cursor": 5, "pipeline": 5, "slot_state": 5, "http": 6, "live_not_built": 7, "metrics": 8, "live": 5}


class ConfigError(ValueError):
    pass


def _text(name: str, value: str) -> str:
    if not value.strip():
        raise ConfigError(f"{name} must not be empty")
    return value


def _positive(name: str, value: str) -> int:
    try:
        n = int(value)
    except ValueError:
        raise ConfigError(f"{name} must be a positive integer") from None
    if n <= 0:
        raise ConfigError(f"{name} must be a positive integer")
    return n


def csv_list(name: str, value: str) -> tuple[str, ...]:
    """Trimmed, without repetitions, in order. A blank value is an empty list; an empty item is an error."""
    if not value.strip():
        return ()
    items = [x.strip() for x in value.split(",")]
    if not all(items):
        raise ConfigError(f"{name} has an empty item")
    return tuple(dict.fromkeys(items))


def redact(text: str) -> str:
    """Hide user and password of a URL."""
    head, sep, rest = text.partition("://")
    if sep and "@" in rest.split("/")[0]:
        return f"{head}://***@{rest.split('@', 1)[1]}"
    return text


@dataclass(frozen=True)
class Config:
    run_mode: str = "replay"
    storage_root: str = "tidemark-tables"
    http_addr: str = "127.0.0.1:8080"
    log_filter: str = "app=info"
    replay_path: str = "sample.jsonl"
    stream_name: str = "replay"
    batch_size: int = 500
    channel_capacity: int = 10_000
    endpoint: str | None = None
    token: str | None = field(default=None, repr=False)
    cluster: str = "mainnet-beta"
    subscriptions: tuple[str, ...] = ("slots",)
    account_include: tuple[str, ...] = ()
    account_exclude: tuple[str, ...] = ()
    account_required: tuple[str, ...] = ()
    reconnect_initial_ms: int = 1000
    reconnect_max_ms: int = 30_000
    reconnect_reset_ms: int = 30_000
    reconnect_max_attempts: int | None = None
    exit_after_replay: bool = False
    transport: str = "file"

    def __repr__(self) -> str:
        shown = {f.name: redact(v) if isinstance(v := getattr(self, f.name), str) else v for f in fields(self)}
        if self.token is not None:
            shown["token"] = "***"
        return f"Config({', '.join(f'{k}={v!r}' for k, v in shown.items())})"

    @classmethod
    def from_env(cls, env: Mapping[str, str], live: str = "LIVE_") -> Config:
        """``live`` is the prefix of the live source's variables."""
        d = cls()
        get = lambda k, default: env.get(k, default)
        mode = get("RUN_MODE", d.run_mode)
        if mode not in ("replay", "live"):
            raise ConfigError("RUN_MODE must be replay or live")
        kinds = csv_list(f"{live}SUBSCRIPTIONS", get(f"{live}SUBSCRIPTIONS", ",".join(d.subscriptions)))
        if not kinds or set(kinds) - set(KINDS):
            raise ConfigError(f"{live}SUBSCRIPTIONS must list some of {', '.join(KINDS)}")
        attempts = get(f"{live}RECONNECT_MAX_ATTEMPTS", "0")
        if not attempts.isdigit():
            raise ConfigError(f"{live}RECONNECT_MAX_ATTEMPTS must be a whole number")
        out = cls(
            mode,
            *[_text(k, get(k, v)) for k, v in (("STORAGE_ROOT", d.storage_root), ("HTTP_ADDR", d.http_addr), ("LOG_FILTER", d.log_filter), ("REPLAY_PATH", d.replay_path), ("STREAM_NAME", d.stream_name))],
            *[_positive(k, get(k, str(v))) for k, v in (("STREAM_BATCH_SIZE", d.batch_size), ("STREAM_CHANNEL_CAPACITY", d.channel_capacity))],
            *[_text(k, env[k]) if k in env else None for k in (f"{live}ENDPOINT", f"{live}TOKEN")],
            _text(f"{live}CLUSTER", get(f"{live}CLUSTER", d.cluster)),
            kinds,
            *[csv_list(k, get(k, "")) for k in (f"{live}ACCOUNT_INCLUDE", f"{live}ACCOUNT_EXCLUDE", f"{live}ACCOUNT_REQUIRED")],
            *[_positive(k, get(k, str(v))) for k, v in ((f"{live}RECONNECT_INITIAL_DELAY_MS", d.reconnect_initial_ms), (f"{live}RECONNECT_MAX_DELAY_MS", d.reconnect_max_ms), (f"{live}RECONNECT_RESET_AFTER_MS", d.reconnect_reset_ms))],
            int(attempts) or None,
        )
        return out.checked()

    def checked(self) -> Config:
        if self.reconnect_max_ms < self.reconnect_initial_ms:
            raise ConfigError("the largest reconnect delay is below the first")
        if self.run_mode == "live" and not self.endpoint:
            raise ConfigError("live mode needs an endpoint")
        return self

    def with_args(self, argv: list[str]) -> Config:
        """Arguments override the environment; ``--replay FILE`` sets replay mode."""
        p = argparse.ArgumentParser(add_help=False, exit_on_error=False)
        for flag in ("--replay", "--stream-name", "--storage-root", "--http-addr", "--endpoint", "--cluster", "--subscriptions", "--batch-size", "--channel-capacity", "--account-include", "--account-exclude", "--account-required", "--reconnect-initial-ms", "--reconnect-max-ms", "--reconnect-max-attempts", "--transport"):
            p.add_argument(flag)
        p.add_argument("--exit-after-replay", action="store_true")
        p.add_argument("--live", action="store_true")
        try:
            a = p.parse_args(argv)
        except argparse.ArgumentError as e:
            raise ConfigError(str(e)) from None
        change = {k: v for k, v in (("replay_path", a.replay), ("stream_name", a.stream_name), ("storage_root", a.storage_root), ("http_addr", a.http_addr), ("endpoint", a.endpoint), ("cluster", a.cluster), ("transport", a.transport)) if v is not None}
        change = {k: _text(k, v) for k, v in change.items()}
        if a.replay is not None:
            change["run_mode"] = "replay"
        if a.live:
            change["run_mode"] = "live"
        if a.subscriptions is not None:
            change["subscriptions"] = csv_list("--subscriptions", a.subscriptions)
            if not change["subscriptions"] or set(change["subscriptions"]) - set(KINDS):
                raise ConfigError(f"--subscriptions must list some of {', '.join(KINDS)}")
        for k in ("account_include", "account_exclude", "account_required"):
            if (v := getattr(a, k)) is not None:
                change[k] = csv_list(k, v)
        if a.reconnect_max_attempts is not None:
            if not a.reconnect_max_attempts.isdigit():
                raise ConfigError("reconnect_max_attempts must be a whole number")
            change["reconnect_max_attempts"] = int(a.reconnect_max_attempts) or None
        if a.exit_after_replay:
            change["exit_after_replay"] = True
        for k, v in (("batch_size", a.batch_size), ("channel_capacity", a.channel_capacity), ("reconnect_initial_ms", a.reconnect_initial_ms), ("reconnect_max_ms", a.reconnect_max_ms)):
            if v is not None:
                change[k] = _positive(k, v)
        return Config(**{f.name: getattr(self, f.name) for f in fields(self)} | change).checked()
