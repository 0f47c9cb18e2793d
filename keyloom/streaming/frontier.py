"""The frontier of a feed's key space as streaming state: the lowest timestamp over all its ranges."""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyloom.functions import keys as K
from keyloom.streaming.regions import keyed_state

FRONTIER = "feed string, frontier bigint, emitted bigint, arrival bigint"


class IntervalMap:
    """Disjoint ranges [start, end) of keys (end None: unbounded) with timestamps, in order, and a heap of the
    timestamps: setting a range costs a search, what it overwrites, and the logarithm of the number of ranges."""

    def __init__(self, steps: list[tuple[bytes, bytes | None, int]] = ()):
        self.starts = [s for s, _, _ in steps]
        self.at = {s: (e, t) for s, e, t in steps}
        self.heap = [(t, s) for s, (_, t) in self.at.items()]
        heapq.heapify(self.heap)

    def set(self, start: bytes, end: bytes | None, ts: int) -> None:
        lo = bisect_right(self.starts, start) - 1
        if lo < 0 or (self.at[self.starts[lo]][0] is not None and self.at[self.starts[lo]][0] <= start):
            lo += 1
        hi = len(self.starts) if end is None else bisect_left(self.starts, end)
        made = []
        if lo < hi:
            first, (last_end, last_ts) = self.starts[lo], self.at[self.starts[hi - 1]]
            if first < start:
                made.append((first, start, self.at[first][1]))
            made.append((start, end, ts))
            if end is not None and (last_end is None or last_end > end):
                made.append((end, last_end, last_ts))
        else:
            made.append((start, end, ts))
        for s in self.starts[lo:hi]:
            del self.at[s]
        self.starts[lo:hi] = [s for s, _, _ in made]
        for s, e, t in made:
            self.at[s] = (e, t)
            heapq.heappush(self.heap, (t, s))

    def low(self) -> int | None:
        """The lowest timestamp; heap entries of ranges that are gone are dropped on the way."""
        while self.heap and self.at.get(self.heap[0][1], (None, None))[1] != self.heap[0][0]:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None


class _PartFrontier(StatefulProcessor):
    """The lowest timestamp of a feed's part of the key space: a state entry a range, rewritten only if it changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.steps = handle.getMapState("steps", "start binary", "end binary, ts bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = {bytes(k[0]): (None if v[0] is None else bytes(v[0]), v[1]) for k, v in self.steps.iterator()} if self.steps.exists() else {}
        ranges = IntervalMap([(s, *kept[s]) for s in sorted(kept)])
        last, marks = None, {}
        for r in rows:  # a range's last mark covers those before it
            name = (bytes(r.start), None if r.end is None else bytes(r.end))
            if name not in marks or r.arrival >= marks[name][0]:
                marks[name] = (r.arrival, r.resolved_ts)
        for (start, end), (last, ts) in sorted(marks.items(), key=lambda m: m[1][0]):
            ranges.set(start, end, ts)
        for s in kept.keys() - ranges.at.keys():
            self.steps.removeKey((s,))
        for s, v in ranges.at.items():
            if kept.get(s) != v:
                self.steps.updateValue((s,), v)
        yield Row(feed=key[0], part=key[1], low=ranges.low(), arrival=last)

    def close(self) -> None:
        pass


class _FeedFrontier(StatefulProcessor):
    """The lowest of the parts' timestamps, and the highest frontier so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getMapState("parts", "part int", "low bigint, arrival bigint")
        self.emitted = handle.getValueState("emitted", "ts bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            self.parts.updateValue((r.part,), (r.low, r.arrival))
        parts = [v for _, v in self.parts.iterator()]
        low = min(v[0] for v in parts)
        before = self.emitted.get()[0] if self.emitted.exists() else None
        now = low if before is None else max(before, low)
        if now != before:
            self.emitted.update((now,))
        yield Row(feed=key[0], frontier=low, emitted=now, arrival=max(v[1] for v in parts))

    def close(self) -> None:
        pass


def _last_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each feed and range the last mark of a batch of rows, which covers those before it."""
    for batch in batches:
        batch = batch.take(pc.sort_indices(batch.column("arrival")))  # a stable sort
        names = pd.DataFrame({c: batch.column(c).to_pylist() for c in ("feed", "start", "end")}, dtype=object)
        yield batch.filter(pa.array(~names.duplicated(keep="last").to_numpy()))


def frontier_stream(marks: DataFrame, cuts: list[bytes] = ()) -> DataFrame:
    """From marks (feed, start, end, resolved_ts, arrival): after each batch with marks a feed's frontier, which later
    marks may lower, the highest one so far, which is what may be emitted, and the last mark's arrival.

    The key space is cut at the given keys (ascending) into parts with a state of their own, and marks are cut with
    it, so that a feed of many ranges is not one task; a feed's own state has a number a part. A null feed is one."""
    keyed_state(marks.sparkSession)
    edges = [b"", *cuts]
    low, high = (F.array(*[F.lit(x).cast("binary") for x in xs]) for xs in (edges, [*cuts, None]))
    marks = marks.select("feed", "start", "end", "resolved_ts", "arrival")
    last = marks.mapInArrow(_last_marks, marks.schema)  # few rows a range meet in its part
    pieces = last.select("*", F.posexplode(F.arrays_zip(low.alias("from"), high.alias("to"))).alias("part", "piece"))
    met = pieces.filter(K.overlaps("start", "end", "piece.from", "piece.to"))
    cut = met.select("feed", "part", F.greatest("start", "piece.from").alias("start"), F.least("end", "piece.to").alias("end"), "resolved_ts", "arrival")
    parts = cut.groupBy("feed", "part").transformWithState(_PartFrontier(), "feed string, part int, low bigint, arrival bigint", "append", "none")
    return parts.groupBy("feed").transformWithState(_FeedFrontier(), FRONTIER, "append", "none")
