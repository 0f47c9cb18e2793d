"""Timestamps of ordered logs: milliseconds since 1970 shifted left by 18 bits, plus a logical counter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOGICAL_BITS = 18


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def physical_ms(ts: Column | str) -> Column:
    return F.shiftright(_col(ts), LOGICAL_BITS)


def logical(ts: Column | str) -> Column:
    return _col(ts).bitwiseAND((1 << LOGICAL_BITS) - 1)


def compose(ms: Column | str, count: Column | str | int = 0) -> Column:
    count = F.lit(count) if isinstance(count, int) else _col(count)
    return F.shiftleft(_col(ms).cast("bigint"), LOGICAL_BITS) + count


def as_timestamp(ts: Column | str) -> Column:
    return F.timestamp_millis(physical_ms(ts))


def moved_back(ts: Column | str, ms: int) -> Column:
    """The timestamp so many milliseconds earlier, with the same logical part, and not below 0."""
    return compose(F.greatest(physical_ms(ts) - ms, F.lit(0)), logical(ts))


def micros(column: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp without time zone (exact, whatever the session's zone)."""
    return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {})".format(column)) if isinstance(column, str) else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)


def ago(now_ms: int, milliseconds: int) -> int:
    """A timestamp so long before now; refuses times before 1970."""
    if milliseconds < 0 or milliseconds > now_ms:
        raise ValueError("that long ago there were no timestamps")
    return (now_ms - milliseconds) << LOGICAL_BITS
