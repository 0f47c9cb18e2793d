"""Change logs: filter, order, materialise, turn into writes.

A log has columns op_type (0 unknown, 1 put, 2 delete, 3 resolved marker), key, value, crts (commit timestamp),
sequence (arrival order), expired_ts (unix seconds, 0: never) and others that the operators leave alone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions import keys as K

# Kinds of entries.
UNKNOWN, PUT, DELETE, RESOLVED = 0, 1, 2, 3


def check_filter(key_prefix: str = "", key_pattern: str = "", value_pattern: str = "") -> None:
    """Raise ValueError if the prefix has a bad escape or a pattern is no regular expression."""
    K.unescape(key_prefix)
    for p in (key_pattern, value_pattern):
        try:
            re.compile(p)
        except re.error as e:
            raise ValueError(f"bad pattern {p!r}: {e}") from e


def kv_filter(key_prefix: str = "", key_pattern: str = "", value_pattern: str = "", key: Column | str = "key", value: Column | str = "value", op: Column | str = "op_type") -> Column:
    """Whether an entry passes: its user key has the (escaped) prefix, and key and value match the patterns
    somewhere, as bytes. The value pattern judges puts alone; entries other than puts and deletes pass, and so
    do keys that are not in the second key format."""
    check_filter(key_prefix, key_pattern, value_pattern)
    key, value, op = (F.col(c) if isinstance(c, str) else c for c in (key, value, op))
    user = K.decode_v2(key, on_bad="null")
    ok = F.lit(True)
    if key_prefix:
        ok = ok & F.startswith(user, F.lit(K.unescape(key_prefix)))
    if key_pattern:
        ok = ok & F.regexp_like(K.latin1(user), F.lit(key_pattern))
    if value_pattern:
        ok = ok & ((op == DELETE) | F.regexp_like(K.latin1(F.coalesce(value, F.lit(b""))), F.lit(value_pattern)))
    return ~op.isin(PUT, DELETE) | user.isNull() | ok


def ordered(log: DataFrame) -> DataFrame:
    """The whole order of events: by commit timestamp, markers last, then by arrival."""
    return log.orderBy(*event_order())


def event_order() -> list[Column]:
    return [F.col("crts").asc(), (F.col("op_type") == RESOLVED).asc(), F.col("sequence").asc()]


def released(log: DataFrame, resolved: int | Column) -> DataFrame:
    """Entries that no earlier one can follow: those up to the resolved timestamp."""
    return log.filter(F.col("crts") <= resolved)


def latest(log: DataFrame, *keys: str) -> DataFrame:
    """The last entry of each key by commit timestamp and arrival; partial aggregates before the shuffle."""
    keys = keys or ("key",)
    rest = [c for c in log.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct("crts", "sequence"))
    return log.groupBy(*keys).agg(top.alias("last")).select(*keys, "last.*")


def current_state(log: DataFrame, resolved: int | Column | None = None, *keys: str) -> DataFrame:
    """What a store holds after the log has been applied up to `resolved`: the last put of each key that no
    later delete has removed."""
    entries = log.filter(F.col("op_type").isin(PUT, DELETE))
    return latest(entries if resolved is None else released(entries, resolved), *keys).filter(F.col("op_type") == PUT)


def last_write(pairs: DataFrame, order: str, *keys: str) -> DataFrame:
    """One row a key: the one with the highest `order`."""
    keys = keys or ("key",)
    rest = [c for c in pairs.columns if c not in keys]
    return pairs.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("last")).select(*keys, "last.*")


def as_writes(log: DataFrame, now: int | Column) -> DataFrame:
    """op, ttl and value of each entry as a store takes them: a put that has expired becomes a delete, others
    live for what is left of their time (0: for ever). Keys must be in the second format."""
    now = F.lit(now) if isinstance(now, int) else now
    expired = (F.col("op_type") == PUT) & (F.col("expired_ts") > 0) & (F.col("expired_ts") <= now)
    op = F.when(expired, DELETE).otherwise(F.col("op_type"))
    return log.withColumns({"key": K.decode_v2("key"), "op": op, "ttl": F.when((op == PUT) & (F.col("expired_ts") > 0), F.col("expired_ts") - now).otherwise(0), "value": F.when(op == PUT, F.col("value"))})


def op_runs(log: DataFrame, op: str = "op", by: str | None = None) -> DataFrame:
    """Number the runs of consecutive entries with the same op (column run, from 0), within each `by`.

    Without `by` all entries are one sequence and pass through one task; logs are split by worker or span."""
    w = Window.partitionBy(*([by] if by else [F.lit(0)])).orderBy("crts", "sequence")
    change = F.coalesce((F.col(op) != F.lag(op).over(w)).cast("int"), F.lit(0))
    return log.withColumn("change", change).withColumn("run", F.sum("change").over(w)).drop("change")


def write_batches(log: DataFrame, op: str = "op", by: str | None = None) -> DataFrame:
    """The runs as batches: op, entries, bytes and the first and last timestamp of each."""
    keys = [*([by] if by else []), "run"]
    size = K.approximate_size("key", "value")
    return op_runs(log, op, by).groupBy(*keys).agg(F.first(op).alias(op), F.count("*").alias("entries"), F.sum(size).alias("bytes"), F.min("crts").alias("first_ts"), F.max("crts").alias("last_ts"))


def late_entries_dropped(log: DataFrame, partition_resolved: DataFrame, partition: str = "partition", column: str = "resolved_ts") -> DataFrame:
    """Without entries at or before the resolved timestamp of their partition or of all partitions together:
    what a consumer sees again after a restart."""
    each = partition_resolved.groupBy(partition).agg(F.max(column).alias("own"))
    lowest = each.agg(F.min("own").alias("all"))
    marks = F.broadcast(each.crossJoin(lowest))  # a row a partition of the queue
    return log.join(marks, partition, "left").filter((F.col("crts") > F.coalesce("own", F.lit(-1))) & (F.col("crts") > F.coalesce("all", F.lit(-1)))).drop("own", "all")


def fallbacks(log: DataFrame, by: str, ts: str = "crts", order: str = "sequence") -> DataFrame:
    """Entries whose timestamp is below the highest one seen before them in their group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumn("seen_ts", F.max(ts).over(w)).filter(F.col(ts) < F.col("seen_ts"))


def stuck_penalty(marks: DataFrame, by: str, ts: str = "resolved_ts", order: str = "arrival") -> DataFrame:
    """How many marks in a row have not moved the timestamp forward (column penalty)."""
    w = Window.partitionBy(by).orderBy(order)
    moved = F.coalesce((F.col(ts) > F.lag(ts).over(w)).cast("int"), F.lit(1))
    runs = marks.withColumn("moved", moved).withColumn("run", F.sum("moved").over(w))
    return runs.withColumn("penalty", F.row_number().over(Window.partitionBy(by, "run").orderBy(order)) - 1).drop("moved", "run")


def matched_commits(prewrites: DataFrame, commits: DataFrame) -> DataFrame:
    """Commits with the values of their prewrites, by start timestamp and key. Of several prewrites the last one
    with a value counts: empty ones are signs of life. A commit whose prewrite was rolled back or is not there
    has no row."""
    rank = F.struct((F.length(F.coalesce("value", F.lit(b""))) > 0).cast("int"), F.col("sequence"))
    puts = prewrites.groupBy("start_ts", "key").agg(F.max_by(F.struct("value", "old_value"), rank).alias("p"))
    return commits.drop("value", "old_value").join(puts, ["start_ts", "key"]).select(*[c for c in commits.columns if c not in ("value", "old_value")], "p.value", "p.old_value")


def error_rate(history: DataFrame, ts: str, by: str | None = None, limit: int = 3, minutes: int = 2) -> DataFrame:
    """Errors within the trailing minutes of each error, and whether they reach the limit."""
    w = Window.partitionBy(*([by] if by else [F.lit(0)])).orderBy(ts).rangeBetween(-minutes * 60_000_000, 0)  # microseconds
    return history.withColumn("recent", F.count("*").over(w)).withColumn("stop", F.col("recent") >= limit)


def trimmed_history(history: DataFrame, ts: str, now: int, minutes: int = 10) -> DataFrame:
    """Errors of the trailing minutes before now (microseconds)."""
    return history.filter(F.col(ts) > now - minutes * 60_000_000)
