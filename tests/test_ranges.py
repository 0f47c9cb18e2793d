import pytest
from pyspark.sql import functions as F

from keyloom.operators import ranges as R


def b(x):
    return None if x is None else bytearray(x.encode() if isinstance(x, str) else x)


def table(spark, rows, extra=""):
    return spark.createDataFrame([(b(r[0]), b(r[1]), *r[2:]) for r in rows], "start binary, end binary" + extra)


def plain(df):
    t = lambda x: None if x is None else bytes(x).decode()
    return sorted(((t(r.start), t(r.end)) for r in df.collect()), key=lambda r: r[0])


INF = None


@pytest.mark.parametrize(
    "rows,start,end,want",
    [
        ([], "", INF, [("", INF)]),
        ([("a", "b")], "", INF, [("", "a"), ("b", INF)]),
        ([("a", "b"), ("c", "d")], "", INF, [("", "a"), ("b", "c"), ("d", INF)]),
        ([("a", "b"), ("c", "d")], "a", "c", [("b", "c")]),
        ([("a", "b"), ("c", "d"), ("b", "c")], "", INF, [("", "a"), ("d", INF)]),
        ([("a", "b"), ("b", "d"), ("d", INF)], "", INF, [("", "a")]),
        ([("", "a"), ("a", INF)], "", INF, []),
        ([("a", "e"), ("b", "c"), ("d", "f")], "", "h", [("", "a"), ("f", "h")]),
    ],
)
def test_gaps(spark, rows, start, end, want):
    assert plain(R.gaps(table(spark, rows), start.encode(), end and end.encode())) == want


def test_overwrite_takes_whole_ranges(spark):
    old = table(spark, [("b", "c"), ("c", "d"), ("d", INF)])
    new = R.overwrite(old, table(spark, [("b", "d")]))
    assert plain(new) == [("b", "d"), ("d", INF)]
    assert plain(R.overwrite(new, table(spark, [("b", "c")]))) == [("b", "c"), ("d", INF)]


@pytest.mark.parametrize(
    "a,want",
    [(("", INF), ("a", "c")), (("", "a"), None), (("", "b"), ("a", "b")), (("a", "b"), ("a", "b")), (("aa", "b"), ("aa", "b")), (("b", "c"), ("b", "c")), (("", "\x01"), None), (("c", INF), None)],
)
@pytest.mark.parametrize("limit", [100, 0])
def test_intersection(spark, monkeypatch, a, want, limit):
    monkeypatch.setattr(R.small, "__defaults__", (limit,))
    for x, y in ((a, ("a", "c")), (("a", "c"), a)):
        assert plain(R.intersect(table(spark, [x]), table(spark, [y]))) == ([want] if want else [])


@pytest.mark.parametrize(
    "rows,start,end,want",
    [([], "1", "2", False), ([("", INF)], "1", "2", True), ([("1", "2")], "1", "2", True), ([("0", "4")], "1", "2", True), ([("1", "2"), ("2", "3")], "1", "3", True), ([("1", "2"), ("3", "4")], "1", "4", False), ([("1", "2"), ("2", "3")], "1", "4", True), ([("2", "3")], "1", "3", False)],
)
def test_left_cover(spark, rows, start, end, want):
    assert R.contiguity(table(spark, rows), start.encode(), end.encode(), False).first().contiguous is want


@pytest.mark.parametrize(
    "rows,want",
    [
        ([("1", "2", 0)], [("1", "2", "0")]),
        ([("1", "2", 0), ("1", "2", 1)], [("1", "2", "01")]),
        ([("1", "3", 0), ("2", "3", 1)], [("1", "2", "0"), ("2", "3", "01")]),
        ([("2", "3", 0), ("1", "3", 1)], [("1", "2", "1"), ("2", "3", "01")]),
        ([("1", "2", 0), ("5", "6", 1), ("3", "4", 2)], [("1", "2", "0"), ("3", "4", "2"), ("5", "6", "1")]),
        ([("1", "3", 0), ("3", "4", 1), ("1", "4", 2), ("1", "2", 3), ("2", "4", 4)], [("1", "2", "023"), ("2", "3", "024"), ("3", "4", "124")]),
        ([("1", "2", 0), ("3", "4", 1), ("6", "7", 2), ("1", "5", 3)], [("1", "2", "03"), ("2", "3", "3"), ("3", "4", "13"), ("4", "5", "3"), ("6", "7", "2")]),
        ([("2", "2", 0)], []),
    ],
)
def test_overlay(spark, rows, want):
    got = R.elementary(table(spark, rows, ", p int"), "p").collect()
    assert sorted((bytes(r.start).decode(), bytes(r.end).decode(), "".join(map(str, r.payloads))) for r in got) == want


@pytest.mark.parametrize("limit", [100, 0])
def test_locate_by_broadcast_and_by_bucket(spark, monkeypatch, limit):
    monkeypatch.setattr(R.small, "__defaults__", (limit,))
    layout = table(spark, [("b", "c", 1), ("c", "m", 2), ("m", INF, 3)], ", r int")
    keys = spark.createDataFrame([(b(k),) for k in ("a", "b", "bzz", "c", "lz", "m", "zzz")], "key binary")
    got = {bytes(r.key): r.r for r in R.locate(keys, layout).collect()}
    assert got == {b"b": 1, b"bzz": 1, b"c": 2, b"lz": 2, b"m": 3, b"zzz": 3}
    outer = {bytes(r.key): r.r for r in R.locate(keys, layout, how="left").collect()}
    assert outer == got | {b"a": None}
    assert R.in_any(keys, layout).count() == 6
    split = R.split_keys_by_range(keys, layout, "r").collect()
    assert {r.r: [bytes(k) for k in r.split_keys] for r in split} == {1: [b"bzz"], 2: [b"lz"], 3: [b"zzz"]}


def test_steps_and_locks(spark):
    sets = table(spark, [("a", "d", 5, 0), ("b", "c", 9, 1), ("c", INF, 7, 2)], ", ts int, o int")
    steps = R.step_function(sets, "ts", "o")
    assert sorted((bytes(r.start), r.end and bytes(r.end), r.ts) for r in steps.collect()) == [(b"a", b"b", 5), (b"b", b"c", 9), (b"c", b"d", 7), (b"d", None, 7)]
    assert R.minimum_over(steps, b"b", b"c", "ts").first().ts == 9
    locks = table(spark, [("a", "c", 3), ("e", "f", 9)], ", version int")
    newer, free = R.stale_or_gaps(locks, b"a", b"g", 5)
    assert newer.count() == 1 and plain(free) == [("a", "e"), ("f", "g")]
    assert plain(R.covered(table(spark, [("a", "c"), ("b", "d"), ("e", "f"), ("f", INF)]))) == [("a", "d"), ("e", None)]
    assert F is not None
