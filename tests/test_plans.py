import os

import pytest
from pyspark.sql import functions as F

from keyloom.operators import checksums, folds, placement
from keyloom.plans import backups, bulkload, feeds
from keyloom.sources import pairs

S, N = 96 << 20, 960_000


@pytest.mark.parametrize(
    "files,want",
    [
        ([(S, 1), (1, 1)], [1, 1]), ([(1, 1), (S, 1)], [1, 1]), ([(1, N), (1, 1)], [1, 1]), ([(1, 1), (1, N)], [1, 1]), ([(1, 1)] * 3, [3]),
        ([(S // 3, 1), (S // 3, 1), (S // 2, 1)], [2, 1]), ([(S // 3, 1), (S // 3, 1), (S // 2, 1), (1, 1)], [2, 2]), ([(S // 3, 1), (S // 3, 1), (S, 1), (S // 2, 1), (1, 1)], [2, 1, 2]), ([(S, 1), (0, 5)], [2]),
    ],
)
def test_merge(spark, files, want):
    df = spark.createDataFrame([(1, i, b, k) for i, (b, k) in enumerate(files)], "t int, i int, total_bytes bigint, total_kvs bigint")
    got = folds.merge_ranges(df, "t", "i").groupBy("group").count().orderBy("group").collect()
    assert [r["count"] for r in got] == want


def test_merge_needs_files(spark):
    none = spark.createDataFrame([], "cf string, total_bytes bigint, total_kvs bigint")
    with pytest.raises(Exception, match="no default or write files"):
        folds.merge_statistics(none, none).collect()


def test_placement(spark):
    workers = spark.createDataFrame([("capture-1",), ("capture-2",), ("capture-3",)], "capture_id string")
    spans = spark.createDataFrame([(i, "capture-1" if i < 5 else "capture-2") for i in range(1, 7)], "keyspan_id int, capture_id string")
    assert sorted(r.keyspan_id for r in placement.victims(workers, spans).collect()) == [1, 2]
    assert placement.least_loaded(placement.loads(workers, spans)).first().capture_id == "capture-3"
    even = placement.rebalanced(workers, spans)
    assert sorted(r["count"] for r in even.groupBy("capture_id").count().collect()) == [2, 2, 2]
    w = spark.createDataFrame([("a", 2), ("b", 1), ("b", 2), ("b", 8), ("c", 1)], "capture_id string, w bigint")
    got = placement.skew(placement.loads(w.select("capture_id").distinct(), w, load="w")).first()
    assert got.total == 14 and got.average == 4 and got.skewness > 0.9


def test_bulk_load(spark, tmp_path):
    v1 = [(f"k_{i}", f"v1_{i}", 1) for i in range(1, 101)] * 2
    v2 = [(f"k_{i}", f"v2_{i}", 2) for i in range(1, 51)]
    df = spark.createDataFrame(v1 + v2, "key string, value string, o int").select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "o")
    got = bulkload.ingest(df, str(tmp_path / "x"), "o")
    assert {bytes(r.key).decode(): bytes(r.value).decode() for r in got.collect()} == {f"k_{i}": f"v{2 if i <= 50 else 1}_{i}" for i in range(1, 101)}
    assert got.count() == 100
    with pytest.raises(Exception, match="(?i)exists"):
        bulkload.ingest(df, str(tmp_path / "x"), "o")
    p = bulkload.profile(df)
    assert (p.count, p.low, p.high) == (250, b"k_1", b"k_99")
    assert bulkload.split_count(p, 100, fixed=7) == 7 and bulkload.split_count(p, 100) == 1
    assert bulkload.split_count(bulkload.Profile(10_000_000, b"", b"", 50), 1000) == 11
    # 1000 pairs of 2**20 bytes over regions of 96 MiB: floor(1000 / 100,663,296 * 1,048,576) = floor(10.42)
    assert bulkload.split_count(bulkload.Profile(1000, b"", b"", 1 << 20), 1000) == 10
    points = bulkload.split_points(df.select("key").distinct(), 4)
    keys = sorted(f"k_{i}".encode() for i in range(1, 101))
    assert [(r.place, bytes(r.key)) for r in points.orderBy("place").collect()] == [(i, keys[20 * i]) for i in range(1, 5)]
    layout = bulkload.ranges_from(points)
    assert sorted(r["count"] for r in bulkload.assign(got, layout).groupBy("range_id").count().collect()) == [20] * 5
    with pytest.raises(Exception, match="no range"):
        bulkload.assign(got, layout.filter("range_id > 0")).collect()


def test_backup(spark, tmp_path):
    data = pairs.generated(spark, 5000, "indexInfo_:_", value=b"v0").union(spark.createDataFrame([(bytearray(b"zz"), None)], "key binary, value binary"))
    path = str(tmp_path / "b")
    files = backups.backup(data, path)
    assert files.agg(F.sum("total_kvs")).first()[0] == 5001
    assert backups.verify(spark, path).first().equal
    got = backups.restore(spark, path, b"indexInfo_:_0000000000000100", b"indexInfo_:_0000000000000200")
    assert got.count() == 100
    assert checksums.equal(checksums.checksum(data), checksums.checksum(backups.restore(spark, path))).first().equal
    whole = spark.createDataFrame([(bytearray(b"a"), bytearray(b"b"))], "start binary, end binary")
    with pytest.raises(ValueError):
        backups.select_files(files, whole, b"a", None)
    assert os.path.isdir(path)


def test_checksum_does_not_depend_on_parts(spark):
    data = pairs.generated(spark, 10240, "indexInfo_:").withColumn("part", F.expr("cast(substring(key, -4) as string) % 5"))
    parts = checksums.checksum(data, "part").withColumnRenamed("crc64_xor", "crc64xor")
    assert checksums.equal(checksums.merged(parts), checksums.checksum(data)).first().equal
    changed = data.withColumn("value", F.when(F.substring("key", -4, 4) == F.lit(b"0007"), F.lit(b"x")).otherwise(F.col("value")))
    assert not checksums.equal(checksums.checksum(changed), checksums.checksum(data)).first().equal
    assert {r.difference for r in checksums.differences(data.select("key", "value"), changed.select("key", "value")).collect()} == {"changed"}
    assert checksums.checksum(data.limit(0)).first().total_kvs == 0


def test_manifests(spark):
    files = [{"name": f"f{i}", "sha256": bytes([i]) * 4} for i in range(20)]
    for limit, n in ((1 << 20, 1), (100, 11)):
        docs = backups.manifest({"version": 2}, iter(files), limit)
        assert (len(docs) == 1) == (n == 1) and [f["name"] for f in backups.manifest_files(docs)] == [f"f{i}" for i in range(20)]
    docs["manifest-000000"] += b" "
    with pytest.raises(ValueError):
        list(backups.manifest_files(docs))
    key = backups.new_key()
    r = spark.range(1).select(backups.unseal(backups.seal(F.lit(b"text"), F.lit(key)), F.lit(key)).alias("t")).first()
    assert bytes(r.t) == b"text"


def test_feeds(spark):
    f = feeds.Feed("a-1", "store:///x", 5, target_ts=10)
    for bad in ({"id": "a_b"}, {"sink": "ftp://x"}, {"target_ts": 5}, {"start_key": b"b", "end_key": b"a"}):
        with pytest.raises(ValueError):
            feeds.Feed(**({"id": "a", "sink": "blackhole://", "start_ts": 5} | bad))
    assert feeds.after_admin(f, "stop").state == "stopped" and feeds.after_admin(feeds.after_admin(f, "stop"), "resume").state == "normal"
    assert feeds.after_admin(feeds.after_admin(f, "remove"), "stop").state == "removed"
    for t in (0, 1000, 2000):
        f = feeds.after_errors(f, ["x"], t)
    assert f.state == "error" and feeds.after_errors(feeds.Feed("a", "store:///", 1), ["snapshot-lost-by-gc"], 1).state == "failed"
    o = feeds.kafka_options("KAFKA+ssl://h:9092/topic?compression=lz4")
    assert o["topic"] == "topic" and o["kafka.security.protocol"] == "SSL"
    ids = spark.createDataFrame([("a-b", True), ("a--b", False), ("", False), ("x" * 129, False)], "id string, want boolean")
    assert all(r.want == r.got for r in ids.select("want", feeds.valid_id("id").alias("got")).collect())
    table = spark.createDataFrame([(s,) for s in feeds.STATES], "state string")
    assert feeds.listed(table).count() == 3 and feeds.listed(table, "all").count() == 6 and feeds.listed(table, "error").count() == 1
