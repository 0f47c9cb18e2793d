"""Watermarks: smallest timestamps over workers, spans, partitions and pending operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions import timestamps as T
from keyloom.operators import ranges as R


def local_watermark(spans: DataFrame, resolved: str = "resolved_ts", checkpoint: str = "checkpoint_ts", *by: str) -> DataFrame:
    """Smallest resolved timestamp, and the smallest checkpoint, which it caps."""
    low = F.min(resolved)
    return spans.groupBy(*by).agg(low.alias("resolved_ts"), F.least(F.min(checkpoint), low).alias("checkpoint_ts"))


def global_watermark(positions: DataFrame, pending: DataFrame | None = None, owners: DataFrame | None = None, worker: str = "capture_id") -> DataFrame:
    """One row (resolved_ts, checkpoint_ts): the smallest over workers, of those in `owners` only if given, and
    over the boundaries of operations that have not ended. Without any it is NULL: nothing can proceed."""
    if owners is not None:
        positions = positions.join(owners.select(worker).distinct(), worker, "left_semi")
    all_ = positions.select("resolved_ts", "checkpoint_ts")
    if pending is not None:
        all_ = all_.union(pending.select(F.col("boundary_ts"), F.col("boundary_ts")))
    return all_.agg(F.min("resolved_ts").alias("resolved_ts"), F.min("checkpoint_ts").alias("checkpoint_ts"))


def consumer_watermark(marks: DataFrame, partition: str = "partition", ts: str = "resolved_ts") -> DataFrame:
    """The smallest of the partitions' highest resolved timestamps."""
    return marks.groupBy(partition).agg(F.max(ts).alias(ts)).agg(F.min(ts).alias(ts))


def span_frontier(resolved: DataFrame) -> DataFrame:
    """The smallest timestamp over all ranges after marks (start, end, resolved_ts, arrival) have overwritten
    each other in order of arrival; it may fall when a later mark is lower."""
    return R.step_function(resolved, "resolved_ts", "arrival").agg(F.min("resolved_ts").alias("frontier"))


def bounded(ts: Column | str, *bounds: Column | str) -> Column:
    """The timestamp, or the smallest barrier or target below it; missing bounds do not count."""
    return F.least(*[F.col(c) if isinstance(c, str) else c for c in (ts, *bounds)])


def safe(ts: Column | str, ms: int = 3000) -> Column:
    """A timestamp moved back by a safe interval, its logical part kept."""
    return T.moved_back(ts, ms)


def interpolated(log: DataFrame, by: str, ts: str = "crts") -> DataFrame:
    """Per group, timestamps that are known to be complete: each commit timestamp for which a larger one has
    come, with the timestamp that completes it."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(ts)
    return log.select(by, ts).distinct().withColumn("completed_by", F.lead(ts).over(w)).filter("completed_by is not null")


def gc_bound(feeds: DataFrame) -> DataFrame:
    """The highest timestamp that no feed needs: below the smallest checkpoint of feeds that may go on."""
    return feeds.filter(F.col("state").isin("normal", "stopped", "error")).agg((F.min("checkpoint_ts") - 1).alias("safe_point"))


def new_safe_point(service: Column | str, worker: Column | str) -> Column:
    """What a retention worker may clear up to: its own limit, or the services' if that is set and lower."""
    service, worker = (F.col(c) if isinstance(c, str) else c for c in (service, worker))
    return F.when((service > 0) & (service < worker), service).otherwise(worker)


def start_allowed(start_ts: Column | str, safe_point: Column | str) -> Column:
    """Whether a feed can start there: the history is still kept."""
    return (F.col(start_ts) if isinstance(start_ts, str) else start_ts) >= (F.col(safe_point) if isinstance(safe_point, str) else safe_point)


def feed_statistics(samples: DataFrame, feed: str = "id") -> DataFrame:
    """From samples (now_ms, count, resolved_ts, checkpoint_ts): operations a second since the last sample, and
    by how many milliseconds the sink trails the source and the source trails the clock."""
    from pyspark.sql import Window

    w = Window.partitionBy(feed).orderBy("now_ms")
    seconds = (F.col("now_ms") - F.lag("now_ms").over(w)) / 1000
    done = T.physical_ms("checkpoint_ts")
    return samples.withColumns({"ops": (F.col("count") - F.lag("count").over(w)) / seconds, "sink_gap_ms": T.physical_ms("resolved_ts") - done, "replication_gap_ms": F.col("now_ms") - done})
