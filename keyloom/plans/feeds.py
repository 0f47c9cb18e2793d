"""Feeds: what a replication job is, its states, and tables about jobs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from urllib.parse import parse_qs, urlparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of a feed with the numbers that metrics show.
STATES = {"normal": 0, "error": 1, "failed": 2, "stopped": 3, "finished": 4, "removed": 5}
#: Errors within the window (milliseconds) that stop a feed, and how long errors are remembered.
ERROR_LIMIT, ERROR_WINDOW_MS, ERROR_MEMORY_MS = 3, 120_000, 600_000
#: Errors after which trying again is of no use.
FATAL = frozenset({"start-ts-before-gc", "snapshot-lost-by-gc"})
# The names of sinks.
SINKS = {"blackhole", "kafka", "kafka+ssl", "store"}
_ID = re.compile(r"^[a-zA-Z0-9]+(\-[a-zA-Z0-9]+)*$")


def valid_id(column: Column | str) -> Column:
    """Letters and digits in groups joined by hyphens, 128 characters at most."""
    c = F.col(column) if isinstance(column, str) else column
    return F.regexp_like(c, F.lit(_ID.pattern)) & (F.length(c) <= 128)


@dataclass(frozen=True)
class Feed:
    """A job: where to, from and to which timestamp, which keys, and how it is."""

    id: str
    sink: str
    start_ts: int
    target_ts: int | None = None
    start_key: bytes = b""
    end_key: bytes | None = None
    state: str = "normal"
    checkpoint_ts: int = 0
    errors: tuple[int, ...] = field(default=())

    def __post_init__(self):
        if not (_ID.match(self.id) and len(self.id) <= 128):
            raise ValueError(f"bad feed id {self.id!r}")
        if self.target_ts is not None and self.target_ts <= self.start_ts:
            raise ValueError("the target must come after the start")
        if self.end_key is not None and self.start_key >= self.end_key:
            raise ValueError("a key range must start before it ends")
        sink_options(self.sink)


def sink_options(uri: str) -> dict[str, str]:
    """Kind and options of a sink's URI."""
    u = urlparse(uri)
    kind = u.scheme.lower()
    if kind not in SINKS:
        raise ValueError(f"unknown sink {kind!r}")
    return {"kind": kind, "host": u.netloc, "path": u.path} | {k: v[-1] for k, v in parse_qs(u.query).items()}


def kafka_options(uri: str) -> dict[str, str]:
    """Options of Spark's Kafka writer for a sink's URI: no message is lost or written twice."""
    o = sink_options(uri)
    packed = o.get("compression", "none")
    if packed not in ("none", "gzip", "snappy", "lz4", "zstd"):
        raise ValueError(f"unknown compression {packed!r}")
    out = {"kafka.bootstrap.servers": o["host"], "topic": o["path"].strip("/"), "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": packed}
    return out | ({"kafka.security.protocol": "SSL"} if o["kind"] == "kafka+ssl" else {})


def recent_errors(errors: tuple[int, ...], now_ms: int, window_ms: int = ERROR_WINDOW_MS) -> tuple[int, ...]:
    return tuple(e for e in errors if now_ms - e < window_ms)


def after_admin(feed: Feed, job: str) -> Feed:
    """The feed after stop, resume, remove or finish; a job that does not fit the state changes nothing."""
    allowed = {"stop": {"normal", "error"}, "resume": {"failed", "error", "stopped", "finished"}, "remove": set(STATES), "finish": {"normal"}}
    becomes = {"stop": "stopped", "resume": "normal", "remove": "removed", "finish": "finished"}
    if job not in allowed:
        raise ValueError(f"unknown job {job!r}")
    if feed.state not in allowed[job]:
        return feed
    return replace(feed, state=becomes[job], errors=() if job == "resume" else feed.errors)


def after_errors(feed: Feed, codes: list[str], now_ms: int) -> Feed:
    """The feed after errors: failed at once for fatal ones, in error once there are too many within the window."""
    if feed.state != "normal" or not codes:
        return feed
    errors = (*recent_errors(feed.errors, now_ms, ERROR_MEMORY_MS), now_ms)
    if FATAL.intersection(codes):
        return replace(feed, state="failed", errors=errors)
    return replace(feed, state="error" if len(recent_errors(errors, now_ms)) >= ERROR_LIMIT else "normal", errors=errors)


def finished(feed: Feed) -> bool:
    return feed.target_ts is not None and feed.checkpoint_ts >= feed.target_ts


def listed(feeds: DataFrame, state: str = "") -> DataFrame:
    """Feeds of a state; "all" for all of them, "" for those that run or wait."""
    if state == "all":
        return feeds
    return feeds.filter(F.col("state").isin("normal", "stopped", "failed") if not state else F.col("state") == state)


def with_status(feeds: DataFrame, status: DataFrame, state: str = "all") -> DataFrame:
    """Feeds with their checkpoints, for those that have both."""
    return listed(feeds.join(status, "id"), state)


def state_number(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.when(c == s, n) for s, n in STATES.items()], F.lit(-1))
