"""Scans in the order of keys that no single task does: rows are dealt by range and sorted where they are, and what a
scan carries from one part to the next is taken from a row a part."""

from __future__ import annotations

import tempfile
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The number of the part that a row is in; parts follow each other in the order of the keys.
PART = "scan_part"


def written(df: DataFrame) -> DataFrame:
    """Reliable checkpoint below spark.checkpoint.dir, which driver and executors share: what follows reads the same
    rows in the same parts however often it runs. Only local sessions may leave that setting out."""
    sc = df.sparkSession.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


@dataclass
class Ordered:
    """Rows dealt by range of an order and sorted, with the number of their part, and the numbers that there are."""

    rows: DataFrame
    order: list[Column]
    parts: list[int]

    def over(self, low: int = Window.unboundedPreceding, high: int = Window.currentRow):
        """Frame of a part's rows in their order."""
        return self.window().rowsBetween(low, high)

    def window(self):
        return Window.partitionBy(PART).orderBy(*self.order)

    def with_column(self, name: str, value: Column) -> Ordered:
        return Ordered(self.rows.withColumn(name, value), self.order, self.parts)

    def _null(self, name: str, value: Column) -> Ordered:
        """A null of the type that an aggregate has."""
        return self.with_column(name, F.lit(None).cast(self.rows.agg(value.alias(name)).schema[name].dataType))

    def _with(self, name: str, by_part: DataFrame) -> Ordered:
        return Ordered(self.rows.join(F.broadcast(by_part), PART, "left"), self.order, self.parts)

    def numbered(self, name: str = "rank") -> Ordered:
        """Numbered from 0 over all parts; a number a part reaches the driver."""
        out = self.with_column(name, (F.row_number().over(self.window()) - 1).cast("bigint"))
        if len(self.parts) < 2:
            return out
        sizes, before = {r[PART]: r["count"] for r in self.rows.groupBy(PART).count().collect()}, []
        for k, part in enumerate(self.parts):
            before.append((part, sum(sizes[p] for p in self.parts[:k])))
        made = out._with("rows_before", self.rows.sparkSession.createDataFrame(before, f"{PART} int, rows_before bigint"))
        return Ordered(made.rows.withColumn(name, F.col(name) + F.col("rows_before")).drop("rows_before"), self.order, self.parts)

    def carried(self, summary: Column, name: str, have: Column | None = None, forward: bool = True) -> Ordered:
        """With the summary (an aggregate of a part's rows for which `have` is true) of the nearest part before each,
        or after it, that has such rows. There is a summary a part, so they are broadcast."""
        if len(self.parts) < 2:
            return self._null(name, summary)
        facts = written((self.rows if have is None else self.rows.filter(have)).groupBy(F.col(PART).alias("from_part")).agg(summary.alias(name)))
        there, pairs = sorted(r[0] for r in facts.select("from_part").collect()), []
        for part in self.parts:
            at = bisect_left(there, part) - 1 if forward else bisect_right(there, part)
            if 0 <= at < len(there):
                pairs.append((part, there[at]))
        near = self.rows.sparkSession.createDataFrame(pairs, f"{PART} int, from_part int")
        return self._with(name, near.join(F.broadcast(facts), "from_part").drop("from_part"))

    def running(self, value: Column, name: str) -> Ordered:
        """With the maximum of value (a struct of a string and a key) over all earlier parts; a value a part reaches the
        driver."""
        if len(self.parts) < 2:
            return self._null(name, F.max(value))
        found = {r[PART]: r["high"] and (r["high"][0], bytes(r["high"][1])) for r in self.rows.groupBy(PART).agg(F.max(value).alias("high")).collect()}
        out, high = [], None
        for part in self.parts:
            out.append((part, high and (high[0], bytearray(high[1]))))
            high = max((x for x in (high, found[part]) if x is not None), default=None)
        kind = self.rows.agg(F.max(value).alias(name)).schema[name].dataType
        return self._with(name, self.rows.sparkSession.createDataFrame(out, f"{PART} int, {name} {kind.simpleString()}"))


def in_order(df: DataFrame, *order: Column) -> Ordered:
    """The rows dealt by range of `order` and sorted. Rows that are equal in `order` share a part, so a last column
    that tells them apart spreads a hot key over several."""
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id()))
    return Ordered(rows, list(order), sorted(r[PART] for r in rows.select(PART).distinct().collect()))


def as_of(left: DataFrame, right: DataFrame, key: str, start: str, strict: bool = False, name: str = "found") -> DataFrame:
    """Each left row with the right row (a struct column) that has the largest start at or below its key, or below it
    if strict; NULL without any. A null key is above all starts; right starts are not null and not repeated.

    Both sides are dealt by range together and scanned in order, so a row costs no more than its place in the sort.
    Left rows of one key are told apart by their place in the input and may lie in several parts."""
    tag = (0, 1) if strict else (1, 0)
    a = left.select(F.col(key).alias("k"), F.lit(tag[0]).alias("tag"), F.monotonically_increasing_id().alias("place"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("l"), F.lit(None).cast(_struct(right)).alias("r"))
    b = right.select(F.col(start).alias("k"), F.lit(tag[1]).alias("tag"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast(_struct(left)).alias("l"), F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("r"))
    order = [F.col("k").asc_nulls_last(), F.col("tag"), F.col("place")]
    rows = in_order(a.union(b), *order).carried(F.max_by("r", "k"), "before", F.col("r").isNotNull())
    last = F.last("r", ignorenulls=True).over(rows.over())
    return rows.rows.withColumn(name, F.coalesce(last, F.col("before"))).filter(F.col("tag") == tag[0]).select("l.*", name)


def _struct(df: DataFrame) -> str:
    return "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in df.schema) + ">"
