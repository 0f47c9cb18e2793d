"""Small column functions on numbers, flags, identifiers and versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The versions of a cluster from which features are there.
FEATURES = {"api-version-conversion": "6.1.0", "checksum": "6.1.1", "backup-ts": "6.2.0", "split-region": "5.2.0"}


def _col(x: Column | str | int) -> Column:
    return F.col(x) if isinstance(x, str) else F.lit(x) if isinstance(x, int) else x


def clamp(n: Column | str, low: Column | int, high: Column | int) -> Column:
    """The number moved into [low, high]; NULL stays NULL. Where low is above high it is high."""
    n = _col(n)
    return F.when(n.isNotNull(), F.least(_col(high), F.greatest(_col(low), n)))


def next_power_of_two(n: Column | str) -> Column:
    """The smallest power of two that is at least n, for n from 1 to 2**62; by bits, so exact. Others raise an error."""
    n = _col(n).cast("bigint")
    bad = F.raise_error(F.concat(F.lit("no power of two for "), n.cast("string"))).cast("bigint")
    bits = F.length(F.bin(n - 1))  # of n - 1, whose binary form has no leading zeros
    return F.when(n == 1, 1).when((n > 1) & (n <= 1 << 62), F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)).when(n.isNotNull(), bad)


def _mask(flags) -> Column:
    return F.lit(reduce(lambda a, b: a | b, flags, 0)).cast("bigint")


def has_all(flags: Column | str, *wanted: int) -> Column:
    """Whether each wanted flag shares a bit with the flags; true for none wanted."""
    return reduce(lambda a, b: a & b, [(_col(flags).bitwiseAND(F.lit(w).cast("bigint")) != 0) for w in wanted], F.lit(True))


def has_one(flags: Column | str, *wanted: int) -> Column:
    return _col(flags).bitwiseAND(_mask(wanted)) != 0


def with_flags(flags: Column | str, *added: int) -> Column:
    return _col(flags).bitwiseOR(_mask(added))


def toggled(flags: Column | str, *removed: int) -> Column:
    """Without the flags; one that is not there is set instead, as programs that remove by exclusive or do."""
    return reduce(lambda a, b: a.bitwiseXOR(F.lit(b).cast("bigint")), removed, _col(flags))


def uuid_bytes(text: Column | str | None = None) -> Column:
    """The 16 bytes of a UUID's text, or of a new random one."""
    return F.unhex(F.replace(F.uuid() if text is None else _col(text), F.lit("-"), F.lit("")))


def _version(v: Column) -> Column:
    """Numbers, and whether it is a release: drafts come before it."""
    core = F.regexp_extract(v, r"^v?(\d+\.\d+\.\d+)", 1)
    numbers = F.transform(F.split(core, r"\."), lambda x: x.cast("int"))
    return F.when(core != "", F.struct(numbers.alias("numbers"), (~F.regexp_like(v, F.lit(r"^v?\d+\.\d+\.\d+-"))).alias("release")))


def enabled(version: Column | str, feature: str) -> Column:
    """Whether a cluster's version (semantic, with or without v) has a feature; NULL for what is no version."""
    if feature not in FEATURES:
        raise ValueError(f"unknown feature {feature!r}")
    return _version(_col(version)) >= _version(F.lit(FEATURES[feature]))
