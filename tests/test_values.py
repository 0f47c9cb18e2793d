import pytest
from keyloom.functions import values as V
from keyloom.operators import placement, ranges
from pyspark.sql import functions as F


def test_numbers_and_flags(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 1023, 1024, (1 << 62) - 1, 1 << 62, None)], "n bigint")
    want = [1, 2, 4, 4, 8, 1024, 1024, 1 << 62, 1 << 62, None]
    assert [r[0] for r in df.select(V.next_power_of_two("n")).collect()] == want
    for bad in (0, -4, (1 << 62) + 1):
        with pytest.raises(Exception, match="no power of two"):
            spark.range(1).select(V.next_power_of_two(F.lit(bad))).collect()
    r = spark.range(1).select(V.clamp(F.lit(7), 1, 5), V.clamp(F.lit(-7), 1, 5), V.clamp(F.lit(None).cast("int"), 1, 5), V.has_all(F.lit(5)), V.has_one(F.lit(5), 2, 8), V.toggled(F.lit(5), 4, 2)).first()
    assert tuple(r) == (5, 1, None, True, False, 3)
    ids = spark.range(1).select(V.uuid_bytes(F.lit("00112233-4455-6677-8899-aabbccddeeff")), F.length(V.uuid_bytes())).first()
    assert bytes(ids[0]) == bytes.fromhex("00112233445566778899aabbccddeeff") and ids[1] == 16


def test_versions_and_stores(spark):
    rows = [("6.1.0", True, False), ("v6.1.1", True, True), ("6.1.0-alpha", False, False), ("10.0.0", True, True), ("5.9.9", False, False), ("x", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "v string, conversion boolean, checksum boolean")
    got = df.select("conversion", "checksum", V.enabled("v", "api-version-conversion").alias("a"), V.enabled("v", "checksum").alias("b")).collect()
    assert all((r.a, r.b) == (r.conversion, r.checksum) for r in got)
    with pytest.raises(ValueError):
        V.enabled("v", "other")
    stores = spark.createDataFrame([(1, "Up"), (2, "Offline"), (3, None)], "id int, state string")
    assert [r.id for r in placement.live_stores(stores).collect()] == [1]


def test_spans_and_regions(spark):
    b = lambda x: None if x is None else bytearray(x.encode())
    table = lambda rows: spark.createDataFrame([(b(s), b(e)) for s, e in rows], "start binary, end binary")
    parents = table([("a", "c"), ("b", "f"), ("c", "d"), ("m", None)])
    subs = [("a", "c"), ("a", "d"), ("b", "f"), ("c", "e"), ("e", "g"), ("n", None), ("b", None), ("0", "1")]
    got = {(bytes(r.start).decode(), r.end and bytes(r.end).decode()): r.inside for r in ranges.inside_any(table(subs), parents).collect()}
    assert got == dict(zip(subs, [True, False, True, True, False, True, False, False], strict=True))
    with pytest.raises(Exception, match="does not end"):
        ranges.inside_any(table([("b", "b")]), parents).collect()
    assert ranges.region_count(parents, b"c", b"d", encoded=False).first().regions == 2
    assert ranges.region_count(parents, b"n", None, encoded=False).first().regions == 1
