"""Range operators over several parts, with neither side broadcast, against plain versions."""

from random import Random

import pytest
from keyloom.operators import ranges as R
from keyloom.operators import scan
from pyspark.sql import functions as F


@pytest.fixture
def parts(spark, monkeypatch):
    """Small tables in several parts, and every path that large tables take."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(R.small, "__defaults__", (0,))
    monkeypatch.setattr(R, "FEW", 0)
    monkeypatch.setattr(R, "CELL", 3)
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def key(n):
    return b"r\0\0\0" + f"{n:04d}".encode()  # keys of the second format share their first bytes


def table(spark, rows):
    rows = [(None if s is None else bytearray(key(s)), None if e is None else bytearray(key(e)), i) for i, (s, e) in enumerate(rows)]
    return spark.createDataFrame(rows, "start binary, end binary, id int").repartition(3)


def random_ranges(random, n, wide=40):
    out = []
    for _ in range(n):
        s = random.randrange(300)
        out.append((s, None if random.random() < 0.05 else s + random.randrange(wide)))
    return out


def inside(k, r):
    return r[0] <= k and (r[1] is None or k < r[1])


def plain(df):
    return sorted((bytes(r.start), None if r.end is None else bytes(r.end)) for r in df.collect())


def union(rows):
    """Disjoint ranges, on numbers up to 400 and an open end."""
    have = [any(inside(k, r) for r in rows) for k in range(401)]
    out, k = [], 0
    while k < 401:
        if have[k]:
            s = k
            while k < 401 and have[k]:
                k += 1
            out.append((key(s), None if k == 401 else key(k)))
        else:
            k += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_in_parts(parts, seed):
    spark, random = parts, Random(seed)
    rows, others = random_ranges(random, 60), random_ranges(random, 50)
    a, b = table(spark, rows), table(spark, others).withColumnRenamed("id", "other")
    assert plain(R.covered(a)) == union(rows)
    low = min(s for s, _ in rows)
    holes = [(key(0), key(low))] if low else []
    merged = union(rows)
    holes += [(e, s) for (_, e), (s, _) in zip(merged, merged[1:], strict=False)]
    holes += [(merged[-1][1], None)] if merged[-1][1] is not None else []
    assert plain(R.gaps(a, key(0))) == holes
    pairs = [(i, j) for i, r in enumerate(rows) for j, o in enumerate(others) if any(inside(k, r) and inside(k, o) for k in range(401))]
    met = R.intersect(a, b)
    assert "NestedLoop" not in met._jdf.queryExecution().toString()
    assert sorted((r.id, r.other) for r in met.collect()) == pairs
    hit = {i for i, _ in pairs}
    stay = [i for i in range(len(rows)) if i not in hit]
    left = R.overwrite(a, b).filter("id is not null")
    assert sorted(r.id for r in left.collect()) == stay
    pieces = R.elementary(a, "id").collect()
    points = sorted({k for r in rows if r[1] is None or r[0] < r[1] for k in r if k is not None})
    want = []
    for s, e in zip(points, [*points[1:], None], strict=True):
        over = [i for i, r in enumerate(rows) if inside(s, r)]
        if over:
            want.append((key(s), None if e is None else key(e), over))
    assert sorted((bytes(r.start), None if r.end is None else bytes(r.end), r.payloads) for r in pieces) == want


def test_keys_in_parts(parts):
    spark, random = parts, Random(5)
    cuts = sorted(random.sample(range(1, 399), 40))
    layout = [(s, e) for s, e in zip(cuts, [*cuts[1:], None], strict=True) if s % 5]
    keys = [random.randrange(400) for _ in range(300)] + [77] * 600 + [None]  # a hot key, and one that is null
    df = spark.createDataFrame([(None if k is None else bytearray(key(k)), i) for i, k in enumerate(keys)], "key binary, n int").repartition(4)
    want = {i: next((j for j, r in enumerate(layout) if k is not None and inside(k, r)), None) for i, k in enumerate(keys)}
    met = R.locate(df, table(spark, layout), how="left")
    plan = met._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "SinglePartition" not in plan
    assert {r.n: r.id for r in met.collect()} == want
    assert {r.n: r.id for r in R.locate(df, table(spark, layout)).collect()} == {i: j for i, j in want.items() if j is not None}
    spans = random_ranges(random, 12)
    assert sorted(r.n for r in R.in_any(df, table(spark, spans)).collect()) == [i for i, k in enumerate(keys) if k is not None and any(inside(k, r) for r in spans)]
    assert scan.in_order(df, F.col("key"), F.col("n")).numbered().rows.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()[:] == (0, 900, 901)


@pytest.mark.parametrize("broken", [None, 3, 17])
def test_contiguity_in_parts(parts, broken):
    cuts = [0, *range(10, 300, 10)]
    rows = [(s, e) for k, (s, e) in enumerate(zip(cuts, [*cuts[1:], None], strict=True)) if k != broken]
    got = R.contiguity(table(parts, rows), key(0), None).first().contiguous
    assert got is (broken is None)


def test_groups_and_empty_tables_in_parts(parts):
    spark = parts
    rows = [(g, s, s + w) for g in range(4) for s, w in ((1, 5), (3, 9), (20, 0), (30, 2), (31, 4))]
    df = spark.createDataFrame([(g, bytearray(key(s)), bytearray(key(e))) for g, s, e in rows], "g int, start binary, end binary").repartition(3)
    got = sorted((r.g, bytes(r.start), bytes(r.end)) for r in R.covered(df, "g").collect())
    assert got == [(g, key(s), key(e)) for g in range(4) for s, e in ((1, 12), (30, 35))]
    none = table(spark, [])
    assert plain(R.covered(none)) == [] and plain(R.gaps(none, key(0), key(9))) == [(key(0), key(9))]
    assert R.contiguity(none, key(0), None).first().contiguous is False
    assert R.intersect(none, table(spark, [(1, 2)]).withColumnRenamed("id", "o")).count() == 0
    assert R.elementary(none, "id").count() == 0 and R.overwrite(none, none).count() == 0
