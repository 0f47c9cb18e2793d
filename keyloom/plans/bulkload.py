"""Planning of bulk loads: how many ranges, where to split, which range a key goes to, sorted deduplicated runs."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.operators import changelog, ranges, scan

#: Keys and bytes of a range, and the least and most splits.
RANGE_KEYS, RANGE_BYTES = 960_000, 96 << 20


@dataclass(frozen=True)
class Profile:
    """Rows, smallest and largest key, and the average size of a pair, rounded up."""

    count: int
    low: bytes | None
    high: bytes | None
    average: int


def profile(pairs: DataFrame) -> Profile:
    """All facts in one pass."""
    r = pairs.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.ceil(F.avg(F.length("key") + F.coalesce(F.length("value"), F.lit(0)))).alias("size")).first()
    return Profile(r.n, r.low and bytes(r.low), r.high and bytes(r.high), int(r.size or 0))


def split_count(p: Profile, samples: int, fixed: int = 0, least: int = 1, most: int = 10_000, sized: bool = True, range_keys: int = RANGE_KEYS, range_bytes: int = RANGE_BYTES) -> int:
    """How many split points a load needs: `fixed` if positive; otherwise a range for every range_keys, within
    the bounds, or for large pairs as many as their bytes ask for, with ten samples a range at least."""
    if fixed > 0:
        return fixed
    clamp = lambda n: max(least, min(n, most))
    n = clamp(ceil(p.count / range_keys))
    if sized and p.average > range_bytes // range_keys:
        n = clamp(min(floor(p.count / range_bytes * p.average), samples // 10))
    return n


def sample_keys(pairs: DataFrame, count: int, size: int, seed: int = 42) -> DataFrame:
    """About `size` keys without replacement, or all if there are fewer (a sampling operator)."""
    keys = pairs.select("key")
    return keys.sample(False, min(1.0, size / count), seed) if count > size else keys


def split_points(keys: DataFrame, n: int) -> DataFrame:
    """n keys that cut the sorted keys into n + 1 parts of equal counts (place, key), places from 1. Sorting is
    by ranges, written once; each part learns from the counts before it which of its rows are cuts."""
    total = keys.count()
    step = total // (n + 1) if n > 0 else 0
    if not step:
        return keys.limit(0).select(F.lit(0).cast("bigint").alias("place"), "key")
    rank = scan.in_order(keys.select("key"), F.col("key")).numbered().rows
    return rank.filter((F.col("rank") % step == 0) & (F.col("rank") > 0) & (F.col("rank") <= step * n)).select((F.col("rank") / step).cast("bigint").alias("place"), "key")


def ranges_from(points: DataFrame) -> DataFrame:
    """The ranges between split points: range_id from 0, start, end."""
    firsts = points.select("key").union(points.sparkSession.range(1).select(F.lit(b"").alias("key"))).distinct()
    rows = scan.in_order(firsts, F.col("key")).numbered("range_id").carried(F.min("key"), "later", forward=False)
    return rows.rows.select("range_id", F.col("key").alias("start"), F.coalesce(F.lead("key").over(rows.window()), F.col("later")).alias("end"))


def assign(pairs: DataFrame, layout: DataFrame, range_id: str = "range_id") -> DataFrame:
    """Each pair with the range it goes to; a key outside all ranges raises an error."""
    placed = ranges.locate(pairs, layout, how="left")
    missing = F.raise_error(F.concat(F.lit("no range for key "), F.hex("key"))).cast(layout.schema[range_id].dataType)
    return placed.withColumn(range_id, F.coalesce(range_id, missing))


def ingest(pairs: DataFrame, path: str, order: str | None = None, ttl: int = 0, files: int | None = None) -> DataFrame:
    """Write pairs as sorted, disjoint files, one row a key (the highest `order`, else the largest value), and
    return what was written. One shuffle for the keys and one by ranges."""
    one = changelog.last_write(pairs, order or "value") if order else pairs.groupBy("key").agg(F.max("value").alias("value"))
    out = one.withColumn("ttl", F.lit(ttl).cast("bigint"))
    dealt = out.repartitionByRange(files, "key") if files else out.repartitionByRange("key")
    dealt.sortWithinPartitions("key").write.mode("errorifexists").parquet(path)
    return pairs.sparkSession.read.parquet(path)
