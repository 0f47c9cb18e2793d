"""Entries of a span in order, each batch up to its resolved timestamp; what is above it is carried over."""

from __future__ import annotations

import heapq
import pickle
from collections import deque
from collections.abc import Iterator
from itertools import chain, groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from keyloom.operators import changelog
from keyloom.streaming.ordered import RowProcessor, by_key, in_order
from keyloom.streaming.regions import keyed_state

RELEASED = "keyspan_id bigint, place bigint, crts bigint, op_type int, key binary, value binary, sequence bigint"


def order(r: tuple) -> tuple:
    """Entries are (crts, op_type, key, value, sequence): by commit timestamp, markers last, then by arrival."""
    return (r[0], r[1] == changelog.RESOLVED, r[4])


class OrderedRelease(RowProcessor):
    """Per span: sorted runs of entries that wait, by slots of commit timestamps, so that a batch touches the slots of
    its own entries and those that it releases, whatever else waits."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState("waiting", "slot bigint", "entries binary")
        self.span = handle.getValueState("span", "place bigint, slots binary")

    def handleRows(self, key, rows) -> Iterator[tuple]:
        place, slots = self.span.get() if self.span.exists() else (0, pickle.dumps(set()))
        slots, mark = pickle.loads(bytes(slots)), None

        def noted():  # all rows pass before the first comes out in order
            nonlocal mark
            for r in rows:
                if r.op_type == changelog.RESOLVED and (mark is None or r.sequence >= mark[0]):
                    mark = (r.sequence, r.crts)
                yield r

        entries = in_order(noted(), "crts", "marker", "sequence")
        resolved = None if mark is None else mark[1]
        # slots that only wait are released, not touched, before and between those of the batch
        due = deque(sorted(s for s in slots if resolved is not None and s * self.width <= resolved))
        for slot, fresh in chain(groupby(entries, lambda r: r.crts // self.width), [(None, ())]):
            while due and (slot is None or due[0] <= slot):
                if due[0] == slot:
                    due.popleft()
                    break
                for e in self._merged(due.popleft(), (), slots, resolved):
                    yield key[0], place, *e
                    place += 1
            if slot is not None:
                for e in self._merged(slot, fresh, slots, resolved):
                    yield key[0], place, *e
                    place += 1
        self.span.update((place, pickle.dumps(slots)))

    def _merged(self, slot, fresh, slots, resolved) -> Iterator[tuple]:
        """The slot's entries that are released, those that have waited and the batch's; the others wait."""
        held = pickle.loads(bytes(self.waiting.getValue((slot,))[0])) if slot in slots else []
        new = ((r.crts, r.op_type, r.key, r.value, r.sequence) for r in fresh)
        rest = []
        # of equal entries the one that has waited comes first
        for e in heapq.merge(held, new, key=order):
            if resolved is not None and e[0] <= resolved:
                yield e
            else:
                rest.append(e)
        if rest:
            self.waiting.updateValue((slot,), (pickle.dumps(rest),))
            slots.add(slot)
        elif slot in slots:
            self.waiting.removeKey((slot,))
            slots.discard(slot)


def ordered_release(log: DataFrame, width: int = 1 << 28) -> DataFrame:
    """From a streaming log (keyspan_id, crts, op_type, key, value, sequence) with resolved markers: each batch's entries
    up to the last marker of it, in the order of events, numbered within the span (place); markers are put out in
    their places. Entries above it wait in slots of `width` timestamps; a batch without a marker releases nothing."""
    keyed_state(log.sparkSession)
    marker = F.coalesce(F.col("op_type") == changelog.RESOLVED, F.lit(False)).cast("int").alias("marker")
    rows = log.select("keyspan_id", "crts", "op_type", "key", "value", "sequence", marker)
    return by_key(rows, ["keyspan_id"], OrderedRelease(width), RELEASED)
