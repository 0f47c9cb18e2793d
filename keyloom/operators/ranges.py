"""Algebra of key ranges as joins and scans. Ranges have columns start and end (see functions.keys).

Layouts of few ranges (BROADCAST_ROWS, counted first) go to every task as a sorted array of starts, in which each
key is searched. Larger ones are dealt by range together with the keys and scanned in order (see operators.scan), so
that neither side is broadcast, nothing is compared that is not near, and no task sees all ranges."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators import scan

#: Range tables up to this many rows are searched as a broadcast array; a row of it is a key.
BROADCAST_ROWS = 100_000
#: Range tables up to this many rows are compared with every row of another.
FEW = 1000
#: Ends of ranges in a cell in which two large tables of ranges meet.
CELL = 64


def small(ranges: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most `limit` rows; reads no more than that."""
    return ranges.limit(limit + 1).count() <= limit


def _real(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Without empty ranges."""
    return ranges.filter(F.col(end).isNull() | (F.col(start) < F.col(end)))


def _start_at_or_below(ranges: DataFrame, key: str, start: str) -> Column:
    """The largest start of few ranges that is not above the key; NULL for a null key or one below all."""
    starts = ranges.sparkSession.sparkContext.broadcast(sorted(bytes(r[0]) for r in ranges.select(start).collect()))

    @F.pandas_udf("binary")
    def found(keys: pd.Series) -> pd.Series:
        have = starts.value
        at = [0 if k is None else bisect_right(have, bytes(k)) for k in keys]
        return pd.Series([have[i - 1] if i else None for i in at], dtype=object)

    return found(F.col(key))


def locate(keys: DataFrame, ranges: DataFrame, key: str = "key", start: str = "start", end: str = "end", how: str = "inner") -> DataFrame:
    """Each key with the range that holds it (ranges do not overlap; with how="left", keys outside keep NULLs, and so
    do null keys). Empty ranges hold nothing."""
    real = _real(ranges, start, end)
    if small(ranges):
        met = keys.withColumn("start_below", _start_at_or_below(real, key, start))
        return met.join(F.broadcast(real), (F.col("start_below") == F.col(start)) & K.in_span(key, start, end), how).drop("start_below")
    met = scan.as_of(keys, real, key, start)
    inside = K.in_span(key, f"found.{start}", f"found.{end}")
    met = met.filter(inside) if how == "inner" else met.withColumn("found", F.when(inside, F.col("found")))
    return met.select(*keys.columns, "found.*")


def in_any(keys: DataFrame, ranges: DataFrame, key: str = "key", start: str = "start", end: str = "end") -> DataFrame:
    """Keys that some range holds, each once however many do."""
    spans = covered(ranges.select(F.col(start).alias("start"), F.col(end).alias("end"))).toDF("span_start", "span_end")
    return locate(keys, scan.written(spans), key, "span_start", "span_end").select(*keys.columns)


def split_keys_by_range(split_keys: DataFrame, ranges: DataFrame, range_id: str, key: str = "key") -> DataFrame:
    """Split keys strictly inside each range (a range's own start does not split it), sorted."""
    met = locate(split_keys, ranges, key).filter(F.col(key) > F.col("start"))
    return met.groupBy(range_id).agg(F.sort_array(F.collect_set(key)).alias("split_keys"))


def _celled(sides: list[DataFrame]) -> list[DataFrame]:
    """The tables of ranges with the cells of their starts (cell) and ends (last_cell): cells are CELL ends of ranges of
    all tables, in their order, so that they are as fine as the ranges are dense."""
    points = [p.select(F.col(c).alias("p")) for p in sides for c in ("start", "end")]
    all_ = points[0].union(points[1]).union(points[2]).union(points[3]).filter("p is not null").distinct()
    cells = scan.written(scan.in_order(all_, F.col("p").asc()).numbered().rows.select("p", F.expr(f"rank div {CELL}").alias("c")))
    top = cells.agg(F.max("c")).first()[0] or 0
    out = []
    for side in sides:
        met = side.join(cells.select(F.col("p").alias("start"), F.col("c").alias("cell")), "start")
        met = met.join(cells.select(F.col("p").alias("end"), F.col("c").alias("last_cell")), "end", "left")
        out.append(met.withColumn("last_cell", F.coalesce("last_cell", F.lit(top))))
    return out


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Overlapping pairs of two range tables with their common range; other columns of both are kept.

    Of a pair one range starts in the other, so ranges meet in the cell of the later start: one side goes to the cell
    of its start and the other to all cells that it reaches into, and then the other way round."""
    rest = lambda df: [c for c in df.columns if c not in ("start", "end")]
    names = lambda df, p, more=(): df.select(*[F.col(c).alias(f"{p}_{c}") for c in ("start", "end", *more)], *[c for c in rest(df) if c not in more])
    overlap = K.overlaps("a_start", "a_end", "b_start", "b_end")
    columns = [*rest(a), *rest(b), "a_start", "a_end", "b_start", "b_end"]
    if small(b, FEW):
        met = names(a, "a").join(F.broadcast(names(b, "b")), overlap).select(*columns)
    else:
        more = ("cell", "last_cell")
        left, right = (names(x, p, more) for x, p in zip(_celled([_real(a, "start", "end"), _real(b, "start", "end")]), "ab", strict=True))
        reach = lambda df, p: df.withColumn("cell", F.explode(F.sequence(f"{p}_cell", f"{p}_last_cell")))
        starts = lambda df, p: df.withColumn("cell", F.col(f"{p}_cell"))
        in_a = reach(left, "a").join(starts(right, "b"), "cell").filter(overlap & (F.col("b_start") >= F.col("a_start")))
        in_b = starts(left, "a").join(reach(right, "b"), "cell").filter(overlap & (F.col("a_start") > F.col("b_start")))
        met = in_a.select(*columns).union(in_b.select(*columns))
    # greatest and least skip NULLs, which is right for unbounded ends
    return met.withColumns({"start": F.greatest("a_start", "b_start"), "end": F.least("a_end", "b_end")}).drop("a_start", "a_end", "b_start", "b_end")


def _code(end: Column | str) -> Column:
    """An end as a key that compares as ends do: unbounded ones are above all others."""
    end = F.col(end) if isinstance(end, str) else end
    return F.when(end.isNull(), F.lit(b"\x01")).otherwise(F.concat(F.lit(b"\x00"), end))


def _decode(code: Column) -> Column:
    return F.when(code != F.lit(b"\x01"), F.substring(code, 2, 2**31 - 1))


def covered(ranges: DataFrame, within: str | None = None) -> DataFrame:
    """Union of the ranges of each group as disjoint ranges that do not touch. Empty ranges cover nothing."""
    group = F.coalesce(F.concat(F.lit("="), F.col(within).cast("string")), F.lit("")) if within else F.lit("")
    real = _real(ranges, "start", "end").select(*([within] if within else []), "start", "end", group.alias("group_name"), _code("end").alias("end_code"))
    mark = F.struct("group_name", "end_code")
    rows = scan.in_order(real, F.col("group_name"), F.col("start"), F.col("end_code")).running(mark, "earlier")
    rows = rows.with_column("before", F.greatest(F.max(mark).over(rows.over(high=-1)), F.col("earlier")))
    joins = (F.col("before.group_name") == F.col("group_name")) & (_code("start") <= F.col("before.end_code"))
    rows = rows.with_column("head", F.when(~F.coalesce(joins, F.lit(False)), F.struct("group_name", "start"))).carried(F.max("head"), "earlier_head", F.col("head").isNotNull())
    island = F.coalesce(F.last("head", ignorenulls=True).over(rows.over()), F.col("earlier_head"))
    out = rows.rows.withColumn("island", island).groupBy(*([within] if within else []), "island").agg(F.max("end_code").alias("end_code"))
    return out.select(*([within] if within else []), F.col("island.start").alias("start"), _decode(F.col("end_code")).alias("end"))


def gaps(ranges: DataFrame, start: bytes = b"", end: bytes | None = None) -> DataFrame:
    """The parts of [start, end) that no range covers. Ranges may overlap, touch or reach outside."""
    low, high = F.lit(start), F.lit(end).cast("binary")
    met = _real(ranges, "start", "end").filter(K.overlaps("start", "end", low, high))
    islands = covered(met.select(F.greatest("start", low).alias("start"), F.least("end", high).alias("end")))
    rows = scan.in_order(islands, F.col("start"), F.col("end")).carried(F.max_by(F.struct("end"), "start"), "earlier")
    before = F.coalesce(F.lag(F.struct("end")).over(rows.window()), F.col("earlier"))
    found = rows.rows.select(F.when(before.isNull(), low).otherwise(before["end"]).alias("from"), F.col("start").alias("to"))
    inner = found.filter("`from` < `to`").select(F.col("from").alias("start"), F.col("to").alias("end"))
    last = islands.agg(F.max(_code("end")).alias("e")).select(F.coalesce("e", F.concat(F.lit(b"\x00"), low)).alias("e"))
    tail = last.filter(F.col("e") < _code(high)).select(_decode(F.col("e")).alias("start"), high.alias("end"))
    return inner.union(tail)


def elementary(coverings: DataFrame, payload: str) -> DataFrame:
    """The coverings cut at all their ends: each piece with the payloads of the ranges over it, in the order of
    `payload`. Empty ranges are left out."""
    real = _real(coverings, "start", "end")
    points = real.select(F.col("start").alias("p")).union(real.filter("end is not null").select("end")).distinct()
    rows = scan.in_order(points, F.col("p").asc()).carried(F.min("p"), "later", forward=False)
    pieces = rows.rows.select(F.col("p").alias("start"), F.coalesce(F.lead("p").over(rows.window()), F.col("later")).alias("end"))
    met = intersect(scan.written(pieces).withColumns({"piece": F.col("start"), "to": F.col("end")}), real)
    return met.groupBy(F.col("piece").alias("start"), F.col("to").alias("end")).agg(F.transform(F.array_sort(F.collect_list(F.struct(payload))), lambda s: s[payload]).alias("payloads"))


def overwrite(old: DataFrame, new: DataFrame) -> DataFrame:
    """Put ranges into a set of ranges: every old one that a new one overlaps goes as a whole. Empty ranges overlap
    nothing."""
    if small(new, FEW):
        a, b = old.alias("o"), _real(new, "start", "end").alias("n")
        share = K.overlaps("o.start", "o.end", "n.start", "n.end") & (F.col("o.end").isNull() | (F.col("o.start") < F.col("o.end")))
        stay = a.join(F.broadcast(b), share, "left_anti")
    else:  # of the new ranges' union, the last that begins below an old range's end is the one that can reach into it
        met = scan.as_of(old, covered(new.select("start", "end")), "end", "start", strict=True)
        reaches = F.coalesce(F.col("found").isNotNull() & (F.col("found.end").isNull() | (F.col("found.end") > F.col("start"))) & (F.col("end").isNull() | (F.col("start") < F.col("end"))), F.lit(False))
        stay = met.filter(~reaches).select(*old.columns)
    return stay.unionByName(new, allowMissingColumns=True)


def contiguity(ranges: DataFrame, start: bytes, end: bytes | None, to_the_end: bool = True) -> DataFrame:
    """One row: contiguous, whether sorted ranges begin at or before start and each begins where the last ends;
    with to_the_end they must also reach end. No ranges are not contiguous."""
    rows = scan.in_order(ranges.select("start", "end"), F.col("start"), _code("end")).carried(F.max_by(F.struct("end"), F.struct("start", _code("end"))), "earlier")
    rows = rows.with_column("before", F.coalesce(F.lag(F.struct("end")).over(rows.window()), F.col("earlier")))
    chain = rows.rows.withColumn("linked", F.coalesce(F.col("before").isNull() | (F.col("start") == F.col("before.end")), F.lit(False)))
    facts = chain.agg(F.min("start").alias("low"), F.bool_and("linked").alias("linked"), F.max(F.col("end").isNull()).alias("open"), F.max("end").alias("high"), F.count("*").alias("n"))
    reach = (F.col("open") | (F.lit(end is not None) & (F.col("high") >= F.lit(end or b"")))) if to_the_end else F.lit(True)
    return facts.select(F.coalesce((F.col("n") > 0) & (F.col("low") <= F.lit(start)) & F.col("linked") & reach, F.lit(False)).alias("contiguous"))


def step_function(settings: DataFrame, value: str, order: str) -> DataFrame:
    """Ranges set to values one after another (ascending `order`), a later one overwriting: the resulting
    steps (start, end, value)."""
    pieces = elementary(settings.withColumn("setting", F.struct(F.col(order).alias("o"), F.col(value).alias("v"))), "setting")
    return pieces.select("start", "end", F.element_at("payloads", -1)["v"].alias(value))


def minimum_over(steps: DataFrame, start: bytes, end: bytes | None, value: str) -> DataFrame:
    """One row: the smallest value of the steps that overlap the range (NULL without any)."""
    return steps.filter(K.overlaps("start", "end", F.lit(start), F.lit(end).cast("binary"))).agg(F.min(value).alias(value))


def stale_or_gaps(locked: DataFrame, start: bytes, end: bytes | None, version: int) -> tuple[DataFrame, DataFrame]:
    """What a request for a range at some version meets among locked ranges: the locks of that version or a
    newer one (the request is stale if there are any), and the parts that nothing of the kind covers."""
    met = locked.filter(K.overlaps("start", "end", F.lit(start), F.lit(end).cast("binary")))
    newer = met.filter(F.col("version") >= version)
    return newer, gaps(newer, start, end)


def cut(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every file against the ranges that it reaches into, with the common range; empty ones do not appear."""
    return intersect(files, ranges).filter(F.col("end").isNull() | (F.col("start") < F.col("end")))


def inside_any(spans: DataFrame, parents: DataFrame, name: str = "inside") -> DataFrame:
    """Spans with whether one parent holds each whole (a union of several does not count). An empty span raises an
    error. Of the parents that begin at or before a span, the one with the highest end decides."""
    bad = F.raise_error(F.lit("a span does not end after it starts")).cast("binary")
    subs = spans.withColumn("start", F.when(F.col("end").isNull() | (F.col("start") < F.col("end")), F.col("start")).otherwise(bad))
    best = parents.groupBy("start").agg(F.max(_code("end")).alias("reach")).select(F.lit("").alias("all"), "start", "reach")
    mark = F.struct("all", "reach")
    rows = scan.in_order(best, F.col("start")).running(mark, "earlier")
    high = F.greatest(F.max(mark).over(rows.over()), F.col("earlier"))["reach"]
    reached = rows.rows.select(F.col("start").alias("from"), high.alias("reach"))
    met = scan.as_of(subs, reached, "start", "from")
    return met.withColumn(name, F.coalesce(_code("end") <= F.col("found.reach"), F.lit(False))).drop("found")


def region_count(regions: DataFrame, start: bytes = b"", end: bytes | None = None, encoded: bool = True) -> DataFrame:
    """One row: how many regions share keys with [start, end). Where regions are bounded by memory-comparable codes, as
    placement services have them, the ends of the range are encoded first."""
    code = (lambda k: K.encode_memcomparable(F.lit(k))) if encoded else F.lit
    low, high = code(start), F.lit(None).cast("binary") if end is None else code(end)
    return regions.filter(K.overlaps("start", "end", low, high)).agg(F.count("*").alias("regions"))
