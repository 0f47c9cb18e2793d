import pytest
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators import changelog as C
from keyloom.operators import watermarks as W
from keyloom.sources import logs, pairs
from keyloom.streaming import apply


@pytest.mark.parametrize(
    "prefix,pattern,value,want",
    [
        ("key\\x00", "", "", True), ("key\\x00\\x11pattern", "", "", True), ("key\\x00\\x11pattern\\x00", "", "", False), ("key\\x01\\x11pattern", "", "", False),
        ("", r"key\x00", "", True), ("", r"key\x00\x11pattern\x00", "", False), ("", r"\x00\x11", "", True), ("", r"\x11", "", True), ("", r"\x10", "", False), ("", r"\x00[\x00\x11]", "", True), ("", r"\x00.?pattern", "", True),
        ("", "", r"value[\xaa-\xff]+pattern", True), ("", "", r"value[\xaa-\xbb]+pattern", False),
    ],
)
def test_filter(spark, prefix, pattern, value, want):
    row = [(1, bytearray(b"r\0\0\0key\x00\x11pattern"), bytearray(b"value\xaa\xffpattern"))]
    df = spark.createDataFrame(row, "op_type int, key binary, value binary")
    assert df.filter(C.kv_filter(prefix, pattern, value)).count() == int(want)


def test_filter_exceptions(spark):
    df = spark.createDataFrame([(2, bytearray(b"r\0\0\0k"), bytearray(b"")), (3, bytearray(b"r\0\0\0zz"), None), (1, bytearray(b"k"), None)], "op_type int, key binary, value binary")
    assert df.filter(C.kv_filter("k", "k", "nothing")).count() == 3  # a delete, a marker, a key of another format
    for bad in ({"key_prefix": "\\"}, {"key_pattern": "("}, {"value_pattern": "["}):
        with pytest.raises(ValueError):
            C.check_filter(**bad)


def test_writes(spark):
    rows = [(1, 0), (2, 0), (1, 200), (1, 100), (1, 1)]
    df = spark.createDataFrame([(o, bytearray(b"r\0\0\0k"), bytearray(b"v"), e) for o, e in rows], "op_type int, key binary, value binary, expired_ts bigint")
    got = C.as_writes(df, 100).collect()
    assert [(r.op, r.value and bytes(r.value), r.ttl) for r in got] == [(1, b"v", 0), (2, None, 0), (1, b"v", 100), (2, None, 0), (2, None, 0)]
    with pytest.raises(Exception, match="V2 prefix"):
        C.as_writes(df.withColumn("key", F.lit(b"k")), 100).collect()


def test_batches(spark):
    rows = [("a", 1, 1), ("b", 1, 2), ("c", 1, 3), ("d", 2, 4), ("e", 2, 5), ("f", 1, 6)]
    df = spark.createDataFrame([(bytearray(k.encode()), bytearray(b"1"), o, t, t) for k, o, t in rows], "key binary, value binary, op int, crts bigint, sequence bigint")
    got = C.write_batches(df).orderBy("run").collect()
    assert [(r.op, r.entries) for r in got] == [(1, 3), (2, 2), (1, 1)] and sum(r.bytes for r in got) == 12


STEPS = [
    ([("key1", 1, 1), ("key2", 2, 1), ("key1", 4, 2), ("key2", 2, 2)], 0, []),
    ([("key3", 3, 1), ("key4", 2, 1), ("key5", 5, 1)], 3, [("key1", 1), ("key2", 2), ("key2", 2), ("key4", 2), ("key3", 3)]),
    ([], 3, []),
    ([("key6", 7, 1)], 6, [("key1", 4), ("key5", 5)]),
    ([("key3", 7, 2)], 6, []),
    ([("key4", 7, 2)], 8, [("key6", 7), ("key3", 7), ("key4", 7)]),
    ([], 15, []),
]


def test_ordered_release(spark):
    rows, seq, low = [], 0, -1
    for new, resolved, want in STEPS:
        for k, ts, op in new:
            rows.append((k, ts, op, seq))
            seq += 1
        df = spark.createDataFrame(rows, "key string, crts bigint, op_type int, sequence bigint")
        got = C.ordered(C.released(df, resolved).filter(F.col("crts") > low)).collect()
        assert [(r.key, r.crts) for r in got] == want
        low = max(low, resolved)


def test_state_and_duplicates(spark):
    rows = [("a", 1, 1, 1, "x"), ("a", 1, 2, 2, "y"), ("b", 1, 1, 3, "z"), ("b", 2, 5, 4, None), ("c", 3, 9, 5, None)]
    df = spark.createDataFrame(rows, "key string, op_type int, crts bigint, sequence bigint, value string")
    assert [(r.key, r.value) for r in C.current_state(df).collect()] == [("a", "y")]
    assert {(r.key, r.value) for r in C.current_state(df, 1).collect()} == {("a", "x"), ("b", "z")}


def test_late_rows_and_penalties(spark):
    log = spark.createDataFrame([(p, t) for p in (0, 1) for t in (1, 5, 9)], "partition int, crts bigint")
    marks = spark.createDataFrame([(0, 3), (0, 5), (1, 2)], "partition int, resolved_ts bigint")
    assert sorted(map(tuple, C.late_entries_dropped(log, marks).collect())) == [(0, 9), (1, 5), (1, 9)]
    m = spark.createDataFrame([(1, 5, 0), (1, 5, 1), (1, 4, 2), (1, 6, 3), (1, 6, 4)], "region_id int, resolved_ts bigint, arrival int")
    assert [r.penalty for r in C.stuck_penalty(m, "region_id").orderBy("arrival").collect()] == [0, 1, 2, 0, 1]


def test_frontiers(spark):
    marks = [("a", "d", 5)] + [("d", "e", 100), ("g", "h", 200), ("a", "d", 1), ("a", "d", 2), ("a", "d", 1), ("b", "c", 3), ("b", "c", 4), ("a", "d", 3), ("a", "b", 5), ("c", "d", 5), ("b", "c", 5), ("a", "d", 6), ("a", "c", 7), ("b", "d", 8), ("a", "b", 8), ("1", "g", 9), ("g", "i", 10)]
    want = [5, 5, 5, 1, 2, 1, 1, 1, 3, 3, 3, 5, 6, 6, 7, 8, 9, 9]
    df = spark.createDataFrame([(bytearray(s.encode()), bytearray(e.encode()), t, i) for i, (s, e, t) in enumerate(marks)], "start binary, end binary, resolved_ts bigint, arrival int")
    for n in (3, 9, 18):
        assert W.span_frontier(df.filter(F.col("arrival") < n)).first().frontier == want[n - 1]


def test_safe_points(spark):
    df = spark.createDataFrame([(0, 100, 100), (1000, 100, 100), (1000, 10000, 1000)], "s bigint, w bigint, want bigint")
    assert all(r.got == r.want for r in df.select("want", W.new_safe_point("s", "w").alias("got")).collect())
    none = spark.createDataFrame([], "resolved_ts bigint, checkpoint_ts bigint, capture_id string")
    assert W.global_watermark(none).first().checkpoint_ts is None


def test_commits(spark):
    pre = spark.createDataFrame([(1, "a", bytearray(b"v"), None, 1), (1, "a", None, None, 2), (2, "b", None, None, 3)], "start_ts bigint, key string, value binary, old_value binary, sequence bigint")
    com = spark.createDataFrame([(1, "a", 10), (2, "b", 11), (3, "c", 12)], "start_ts bigint, key string, crts bigint").withColumns({"value": F.lit(None).cast("binary"), "old_value": F.lit(None).cast("binary")})
    assert sorted((r.crts, r.value and bytes(r.value)) for r in C.matched_commits(pre, com).collect()) == [(10, b"v"), (11, None)]


def test_sources(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(b"zk"), bytearray(b"value12345678")), (bytearray(b"k"), bytearray(b"v" * 9)), (bytearray(b"z"), bytearray(b"w" * 9)), (None, None)], "key binary, value binary")
    assert {(bytes(r.key), bytes(r.value)) for r in pairs.decode_v1(raw, True).collect()} == {(b"k", b"value"), (b"", b"w")}
    made = pairs.generated(spark, 1000, "test_")
    assert made.filter(F.startswith("key", F.lit(b"test_")) & (F.col("value") == F.lit(b"A" * 64))).count() == 1000
    made.write.parquet(str(tmp_path / "p"))
    got = pairs.scan(pairs.read_parquet(spark, str(tmp_path / "p")), b"test_0000000000000010", b"test_0000000000000020")
    assert got.count() == 10 and "PushedFilters: [" in got._jdf.queryExecution().toString()
    assert pairs.storage_uri("s3://b/p") == "s3a://b/p" and pairs.storage_uri("/x") == "file:///x"
    with pytest.raises(ValueError):
        pairs.storage_uri("ftp://x")
    feed = spark.createDataFrame([("put", None), ("other", None)], "op string, old_value binary")
    with pytest.raises(Exception, match="unknown op"):
        logs.feed_rows(feed).collect()


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    schema = "op_type int, key string, value string, crts bigint, sequence bigint"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
    put([(1, "a", "1", 1, 1), (1, "b", "1", 2, 2)])
    read = lambda: apply.materialise(logs.stream_files(spark, str(src), schema), out)
    assert {(r.key, r.value) for r in read().collect()} == {("a", "1"), ("b", "1")}
    put([(2, "a", None, 3, 3), (1, "c", "2", 4, 4)])
    assert {(r.key, r.value) for r in read().collect()} == {("b", "1"), ("c", "2")}
    assert {(r.key, r.value) for r in read().collect()} == {("b", "1"), ("c", "2")}


def test_latin1(spark):
    assert spark.range(1).select(K.latin1(F.lit(b"\xaa\x80")).alias("t")).first().t == "\xaa\x80"
