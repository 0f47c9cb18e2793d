"""What a key's state processor holds and asks of the store, however many rows a batch has."""

import tracemalloc
from collections import namedtuple
from random import Random

import pandas as pd
import pyarrow as pa
import pytest
from keyloom.functions import codec
from keyloom.streaming import frontier, ordered, regions, release

Event = namedtuple("Event", "sequence crts key")


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 24, 72, 73, 700])
def test_order_with_runs_in_files(monkeypatch, n):
    for name, v in (("RUN", 8), ("BLOCK", 3), ("RUNS", 3)):
        monkeypatch.setattr(ordered, name, v)
    random = Random(n)
    rows = [Event(i, random.randrange(9), b"k") for i in range(n)]
    got = list(ordered.in_order(iter(rows), "crts"))
    assert got == sorted(rows, key=lambda r: r.crts) and all(r.key == b"k" for r in got)


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Map(dict):
    reads = 0

    def exists(self):
        return bool(self)

    def containsKey(self, key):
        self.reads += 1
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.map, self.value = Map(), Value()

    def getMapState(self, *_):
        return self.map

    def getValueState(self, *_):
        return self.value

    def getListState(self, *_):
        return Value()


def made(processor, keys, columns, out):
    processor.keys, processor.columns, processor.out, processor.numbers = keys, columns, out, {"region_id", "keyspan_id", "crts", "sequence", "op_type", "marker"}
    handle = Handle()
    processor.init(handle)
    return processor, handle


def peak(frames, check):
    tracemalloc.start()
    for f in frames:
        check(f)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_a_region_of_many_marks_is_not_held():
    clock, _ = made(regions.RegionClock(), ["region_id"], ["region_id", "kind", "crts", "sequence"], ["region_id", "resolved_ts", "sequence", "ignored", "regressed"])
    n, big, seen = 150_000, 1 << 60, []

    def frames():
        yield pd.DataFrame({"region_id": "1", "kind": "initialized", "crts": [None], "sequence": "-1"})
        for low in range(0, n, 10_000):
            at = [str(big + i) for i in reversed(range(n - low - 10_000, n - low))]
            yield pd.DataFrame({"region_id": "1", "kind": "resolved", "crts": at, "sequence": [str(int(x) - big) for x in at]})

    def check(f):
        assert len(f) <= ordered.OUT and f.columns.tolist() == clock.out
        seen.extend(f.resolved_ts.iloc[[0, -1]])

    assert peak(clock.handleInputRows(("1",), frames(), None), check) < 40 << 20  # as a list over 100 MB
    assert seen[0] == big and seen[-1] == big + n - 1 and seen == sorted(seen)


def test_a_span_of_many_entries_is_not_held():
    held, handle = made(release.OrderedRelease(1000), ["keyspan_id"], ["keyspan_id", "crts", "op_type", "key", "value", "sequence", "marker"], ["keyspan_id", "place", "crts", "op_type", "key", "value", "sequence"])
    n, places = 150_000, []

    def frames():
        for low in range(0, n, 10_000):
            at = [str(n - i) for i in range(low, low + 10_000)]
            yield pd.DataFrame({"keyspan_id": "1", "crts": at, "op_type": "1", "key": [b"k" + x.encode() for x in at], "value": [b"v" * 20 + x.encode() for x in at], "sequence": at, "marker": "0"})
        yield pd.DataFrame({"keyspan_id": "1", "crts": [str(n - 500)], "op_type": "3", "key": [None], "value": [None], "sequence": str(n + 1), "marker": "1"})

    def check(f):
        assert (f.crts - 1 == f.place).all() or f.op_type.iloc[-1] == 3
        places.extend(f.place)

    assert peak(held.handleInputRows(("1",), frames(), None), check) < 40 << 20
    assert places == list(range(n - 500 + 1)) and sorted(handle.map) == [(149,), (150,)]


def test_prewrites_that_are_not_stored_are_not_asked_for():
    matcher, handle = made(regions.CommitMatcher(), ["region_id", "part"], ["kind", "key", "start_ts", "crts", "op_type", "value", "old_value", "sequence"], None)
    handle.map.update({(-1 - i, b"old"): (b"v", None) for i in range(2000)})
    Row = namedtuple("Row", matcher.columns)
    rows = [Row("initialized", None, None, None, 1, None, None, -1)]
    for i in range(20_000):
        rows += [Row("prewrite", b"k", i, None, 1, b"%d" % i, None, 2 * i), Row("commit", b"k", i, i + 1, 1, None, None, 2 * i + 1)]
    rows += [Row("commit", b"old", -1 - i, 99999, 1, None, None, 50_000 + i) for i in range(3)] + [Row("prewrite", b"k", 77, None, 1, b"open", None, 60_000)]
    out = list(matcher.handleRows((1, 0), iter(rows)))
    assert [r[3] for r in out] == [b"%d" % i for i in range(20_000)] + [b"v"] * 3 and all(r[8] is None for r in out)
    assert handle.map.reads < 1500
    assert (-1, b"old") not in handle.map and handle.map[77, b"k"] == (b"open", None) and len(handle.map) == 1998


def test_few_marks_of_a_batch_reach_the_frontier():
    n = 5000
    marks = pa.RecordBatch.from_pydict({"feed": [None if i % 2 else "f" for i in range(n)], "start": [b"%d" % (i % 7) for i in range(n)], "end": [None] * n, "resolved_ts": [1 << 60 | i for i in range(n)], "arrival": [n - i for i in range(n)]},
                                       pa.schema([("feed", pa.string()), ("start", pa.binary()), ("end", pa.binary()), ("resolved_ts", pa.int64()), ("arrival", pa.int64())]))
    (got,) = frontier._last_marks(iter([marks]))
    assert sorted(got.column("resolved_ts").to_pylist()) == [1 << 60 | i for i in range(14)] and got.schema == marks.schema


def test_messages_are_decoded_in_small_frames(spark):
    one = codec.decode_message
    log = spark.createDataFrame([(1, 1, bytearray(b"k%d" % i), bytearray(b"v"), i, 0, i) for i in range(3000)], "q int, op_type int, key binary, value binary, crts bigint, expired_ts bigint, sequence bigint")
    messages = codec.encode(log, "q", 100_000, 1000)
    frame = pd.concat([messages.select("q", "key", "value").toPandas()] * 5)

    class Messages:
        schema = messages.select("q").schema

        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            return list(run(iter([frame])))

    frames = codec.decode(Messages(), "q")
    assert max(map(len, frames)) <= codec.DECODED < sum(map(len, frames)) == 15_000
    assert list(one(bytes(frame.key.iloc[0]), bytes(frame.value.iloc[0])))[0][:4] == (1, b"k0", b"v", 0)
