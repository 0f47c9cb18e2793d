"""Where spans go: loads, the least loaded worker, what to move."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.operators import scan


def loads(workers: DataFrame, spans: DataFrame, worker: str = "capture_id", load: str | None = None) -> DataFrame:
    """Spans (or the sum of `load`) of each worker, 0 for idle ones."""
    each = spans.groupBy(worker).agg((F.sum(load) if load else F.count("*")).cast("bigint").alias("load"))
    return workers.select(worker).join(each, worker, "left").fillna(0, ["load"])


def skew(loaded: DataFrame) -> DataFrame:
    """total, average (whole number) and skewness: the deviation of the loads over their mean."""
    return loaded.agg(F.sum("load").alias("total"), F.expr("sum(load) div count(*)").alias("average"), (F.stddev_pop("load") / F.avg("load")).alias("skewness"))


def least_loaded(loaded: DataFrame, worker: str = "capture_id") -> DataFrame:
    """The worker with the lowest load, the smallest id of equals."""
    return loaded.agg(F.min_by(worker, F.struct("load", worker)).alias(worker))


def victims(workers: DataFrame, spans: DataFrame, worker: str = "capture_id", span: str = "keyspan_id") -> DataFrame:
    """Spans to take away: of each worker the first ones by id that exceed the even share, rounded up."""
    share = spans.agg(F.count("*").alias("total")).crossJoin(workers.agg(F.count("*").alias("workers"))).select(F.ceil(F.col("total") / F.col("workers")).alias("share"))
    w = Window.partitionBy(worker)
    placed = spans.withColumns({"n": F.count("*").over(w), "rank": F.row_number().over(w.orderBy(span))})
    return placed.crossJoin(F.broadcast(share)).filter(F.col("rank") <= F.col("n") - F.col("share")).select(worker, span)  # share: one row


def rebalanced(workers: DataFrame, spans: DataFrame, worker: str = "capture_id", span: str = "keyspan_id") -> DataFrame:
    """An even assignment that moves as few spans as possible: victims fill the workers with room, those with
    most room first. Both sides are numbered and joined by number."""
    moving = victims(workers, spans, worker, span)
    left = spans.join(moving.select(span), span, "left_anti")
    total, n = spans.count(), workers.count()
    have = loads(workers, left, worker).select(worker, "load")
    share, extra = divmod(total, n) if n else (0, 0)
    rank = Window.orderBy(F.col("load").desc(), worker)  # a row a worker
    room = have.withColumn("room", F.greatest(F.lit(0), F.lit(share) + (F.row_number().over(rank) <= extra).cast("int") - F.col("load")))
    slots = room.select(worker, F.explode(F.expr("if(room > 0, sequence(1, room), array())")).alias("k"))
    numbered = scan.in_order(slots, F.col("k"), F.col(worker)).numbered("slot").rows.select("slot", F.col(worker).alias("to"))
    queued = scan.in_order(moving, F.col(span)).numbered("slot").rows
    moved = queued.join(numbered, "slot").select(span, F.col("to").alias(worker))
    return left.select(span, worker).union(moved)


def assignment_changes(wanted: DataFrame, present: DataFrame, *keys: str) -> DataFrame:
    """What to add and what to remove so that `present` becomes `wanted` (column change)."""
    keys = keys or ("keyspan_id",)
    add = wanted.select(*keys).join(present.select(*keys), list(keys), "left_anti").withColumn("change", F.lit("add"))
    remove = present.select(*keys).join(wanted.select(*keys), list(keys), "left_anti").withColumn("change", F.lit("remove"))
    return add.union(remove)


def ready(wanted: DataFrame, status: DataFrame, related: DataFrame, span: str = "keyspan_id") -> DataFrame:
    """Spans that can start: all spans related to them are stopped or processed."""
    waiting = related.join(status.filter(~F.col("status").isin("stopped", "processed")).select(F.col(span).alias("related_id")), "related_id")
    return wanted.join(waiting.select(span), span, "left_anti")


def oldest(regions: DataFrame, n: int = 64, ts: str = "resolved_ts", key: str = "region_id") -> DataFrame:
    """The n regions that have waited longest (a top-k report)."""
    return regions.orderBy(ts, key).limit(n)


def live_stores(stores: DataFrame, state: str = "state") -> DataFrame:
    """Stores that are up: others are passed over, and what they hold is asked for elsewhere."""
    return stores.filter(F.lower(F.col(state)) == "up")
