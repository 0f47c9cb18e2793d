"""The feed source: order, restarts, markers, batches by bytes."""

from collections import defaultdict

import pytest
from keyloom.sources import feed
from keyloom.streaming import progress
from pyspark.sql import functions as F


def entries(spark, rows):
    return spark.createDataFrame([(r, bytearray(k.encode()), ts - 1, ts, 1, bytearray(b"x" * size)) for r, k, ts, size in rows], "region_id bigint, key binary, start_ts bigint, crts bigint, op_type int, value binary").withColumn("old_value", F.lit(None).cast("binary"))


def run(spark, path, **options):
    stream = feed.stream_feed(spark, f"{path}/feed", **options)
    batches = defaultdict(list)
    query = stream.writeStream.foreachBatch(lambda b, n: batches[n].extend(b.orderBy("region_id", "sequence").collect())).option("checkpointLocation", f"{path}/progress").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [rows for _, rows in sorted(batches.items()) if rows]


def shown(rows, region):
    return [(r.kind, r.crts) for r in rows if r.region_id == region]


def test_feed_from_a_timestamp_and_on(spark, tmp_path):
    path = f"file://{tmp_path}"
    feed.append_feed(entries(spark, [(r, f"k{t}", t, 5) for r in (1, 2) for t in range(1, 9)]), f"{path}/feed", 0)
    (first,) = run(spark, path, start_ts=5)
    for region in (1, 2):
        assert shown(first, region) == [*[("committed", t) for t in (6, 7, 8)], ("initialized", None), ("resolved", 8)]
    feed.append_feed(entries(spark, [(2, "k", 9, 5), (3, "k", 4, 5), (3, "k", 7, 5)]), f"{path}/feed", 1)
    (tmp_path / "feed" / "append=00000002").mkdir()  # not complete
    (second,) = run(spark, path, start_ts=5)
    assert shown(second, 1) == [] and shown(second, 2) == [("committed", 9), ("resolved", 9)]
    assert shown(second, 3) == [("initialized", None), ("committed", 7), ("resolved", 7)]
    assert run(spark, path, start_ts=5) == []
    sequences = [r.sequence for r in [*first, *second] if r.region_id == 2]
    assert sequences == sorted(set(sequences))


def test_batches_by_bytes_never_split_a_timestamp(spark, tmp_path):
    path, rows = f"file://{tmp_path}", []
    for t in range(40):
        rows += [(1, f"k{t}-{i}", t, 2000) for i in range(100)]
    rows += [(1, f"h{i}", 40, 2000) for i in range(900)]  # one timestamp larger than a batch
    rows += [(2, f"k{t}", t, 2000) for t in range(300)]
    made = entries(spark, rows).withColumn("value", F.sha2(F.concat("key", "value"), 256).cast("binary"))
    made = made.withColumn("value", F.concat(*[F.sha2(F.concat("value", F.lit(str(i))), 256).cast("binary") for i in range(30)]))
    feed.append_feed(made, f"{path}/feed", 0, group_bytes=64 << 10)
    quota = 400 << 10
    options = {"max_bytes": quota, "progress": f"{path}/progress"}
    batches = run(spark, path, **options)
    feed.append_feed(made.filter("region_id = 2").withColumn("crts", F.col("crts") + 1000), f"{path}/feed", 1, group_bytes=64 << 10)
    batches += run(spark, path, **options)
    assert len(batches) > 4
    seen, where = [], defaultdict(set)
    for n, batch in enumerate(batches):
        size = sum(len(r.value) + len(r.key) for r in batch if r.value is not None)
        one = {(r.region_id, r.crts) for r in batch if r.kind == "committed"}
        assert size <= 1.1 * quota or len(one) == 1 or (1, 40) in one
        for r in batch:
            if r.kind == "committed":
                seen.append((r.region_id, bytes(r.key), r.crts))
                where[r.region_id, r.crts].add(n)
    assert sorted(seen) == sorted([(r, k.encode(), t) for r, k, t, _ in rows] + [(2, k.encode(), t + 1000) for r, k, t, _ in rows if r == 2])
    assert all(len(x) == 1 for x in where.values())


def test_a_feed_that_goes_back_is_an_error(spark, tmp_path):
    path = f"file://{tmp_path}"
    for n, t in enumerate((9, 3)):
        feed.append_feed(entries(spark, [(1, "k", t, 5)]), f"{path}/feed", n)
    with pytest.raises(Exception, match="goes back"):
        run(spark, path)


def test_a_footer_is_read_once(spark, tmp_path, monkeypatch):
    rows = spark.range(20000).select(F.lit(1).cast("bigint").alias("region_id"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("key"), "id", F.col("id").alias("crts"), F.lit(1).alias("op_type"), F.lit(None).cast("binary").alias("value"), F.lit(None).cast("binary").alias("old_value"))
    feed.append_feed(rows.withColumnRenamed("id", "start_ts").coalesce(1), f"file://{tmp_path}/feed", 0, group_bytes=16 << 10)
    reader = feed.FeedReader({"path": f"file://{tmp_path}/feed", "max_bytes": 64 << 10})
    reader.initialOffset()
    files, groups = {g[0] for g in reader.groups["1"]}, len(reader.groups["1"])
    assert groups > 4 * len(files)
    parsed, whole = [], feed.pq.ParquetFile

    def opened(f, metadata=None):
        parsed.append(metadata is None)
        return whole(f, metadata=metadata)

    monkeypatch.setattr(feed.pq, "ParquetFile", opened)
    at, seen, batches = {}, [], 0
    while (to := reader._admitted(at, reader.quota)) != at:
        for part in reader.partitions({"scan": {}, "at": at}, {"scan": {}, "at": to}):
            seen += [ts for b in reader.read(part) for ts, kind in zip(b.column("crts").to_pylist(), b.column("kind").to_pylist(), strict=True) if kind == "committed"]
        at, batches = to, batches + 1
    assert batches > 3 and seen == list(range(20000))
    assert sum(parsed) == len(files) and len(parsed) <= batches + len(files)


def test_no_more_footers_are_held_than_stated(tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "FOOTERS", 2)
    monkeypatch.setattr(feed, "_FOOTERS", feed.OrderedDict())
    for n in range(4):
        feed.pq.write_table(feed.pa.table({"a": list(range(n + 1))}), f"{tmp_path}/{n}.parquet")
    for n in (0, 1, 2, 3, 2, 0):
        with open(f"{tmp_path}/{n}.parquet", "rb") as f:
            assert feed._opened(f, f"{tmp_path}/{n}.parquet").read_row_group(0).num_rows == n + 1
        assert len(feed._FOOTERS) <= 2


def reader_of(path, **options):
    reader = feed.FeedReader({"path": f"{path}/feed", **options})
    return reader, reader.initialOffset()["scan"]


def test_small_ranges_share_a_task_and_a_record_batch(spark, tmp_path):
    path = f"file://{tmp_path}"
    feed.append_feed(entries(spark, [(r, f"k{t}", t, 5) for r in range(6) for t in range(9)]), f"{path}/feed", 0)
    reader, scan = reader_of(path)
    (part,) = reader.partitions({"scan": scan, "at": {}}, {"scan": scan, "at": scan})
    (batch,) = reader.read(part)
    rows = batch.to_pylist()
    for r in range(6):
        mine = [x for x in rows if x["region_id"] == r]
        assert [(x["kind"], x["crts"]) for x in mine] == [*[("committed", t) for t in range(9)], ("initialized", None), ("resolved", 8)]
        assert [x["sequence"] for x in mine] == sorted({x["sequence"] for x in mine})


def test_large_ranges_keep_tasks_of_their_own(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}"
    feed.append_feed(entries(spark, [(r, f"k{t}", t, 5) for r in range(6) for t in range(900)]), f"{path}/feed", 0, group_bytes=4 << 10)
    reader, scan = reader_of(path)
    size = sum(g[2] for g in reader.groups["0"])
    for limit, tasks in ((size // 2, 6), (2 * size + size // 2, 3)):
        monkeypatch.setattr(feed, "TASK_BYTES", limit)
        made = reader.partitions({"scan": scan, "at": {}}, {"scan": scan, "at": scan})
        assert len(made) == tasks
        rows = [x for part in made for b in reader.read(part) for x in b.to_pylist()]
        assert sorted((x["region_id"], x["crts"]) for x in rows if x["kind"] == "committed") == [(r, t) for r in range(6) for t in range(900)]
        for r in range(6):
            mine = [x["sequence"] for x in rows if x["region_id"] == r]
            assert mine == sorted(set(mine))


def test_a_marker_stays_between_history_and_growth(spark, tmp_path):
    path = f"file://{tmp_path}"
    feed.append_feed(entries(spark, [(1, f"k{t}", t, 5) for t in range(900)]).coalesce(1), f"{path}/feed", 0, group_bytes=4 << 10)
    reader, scan = reader_of(path)
    for n in range(len(reader.groups["1"])):  # the history ends with any row group
        old = {"1": n}
        (part,) = reader.partitions({"scan": old, "at": {}}, {"scan": old, "at": scan})
        rows = [x for b in reader.read(part) for x in b.to_pylist()]
        at = [x["kind"] for x in rows].index("initialized")
        assert [x["crts"] for x in rows[:at]] + [x["crts"] for x in rows[at + 1 : -1]] == list(range(900)) and rows[-1]["kind"] == "resolved"
        assert at == 0 if n == 0 else rows[at - 1]["crts"] == reader.groups["1"][n - 1][4]
        assert [x["sequence"] for x in rows] == sorted({x["sequence"] for x in rows})


def test_rising_timestamps_are_stored_as_differences(spark, tmp_path):
    rows = spark.range(20000).select(F.lit(1).cast("bigint").alias("region_id"), F.lit(b"k").alias("key"), (F.col("id") * 1000).alias("start_ts"), (F.col("id") * 1000).alias("crts"), F.lit(1).alias("op_type"), F.lit(b"v").alias("value"), F.lit(None).cast("binary").alias("old_value"))
    feed.append_feed(rows, f"file://{tmp_path}/feed", 0)
    reader, scan = reader_of(f"file://{tmp_path}")
    assert sum(g[2] for g in reader.groups["1"]) < 20000 * 8
    (part,) = reader.partitions({"scan": scan, "at": {}}, {"scan": scan, "at": scan})
    assert [x for b in reader.read(part) for x in b.column("crts").to_pylist() if x is not None][:20000] == [n * 1000 for n in range(20000)]


def test_logs_of_a_local_stream(spark, tmp_path):
    assert spark.conf.get(progress.MANAGER, None) is None
    path = f"file://{tmp_path}"
    for n in range(2):
        feed.append_feed(entries(spark, [(1, f"k{t}", n * 10 + t, 5) for t in range(9)]), f"{path}/feed", n)
        with progress.plain_logs(spark, path):
            assert spark.conf.get(progress.MANAGER)
            query = feed.stream_feed(spark, f"{path}/feed").writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/progress").start()
            query.processAllAvailable()
            query.stop()
        assert spark.conf.get(progress.MANAGER, None) is None
    got = [r.crts for r in spark.read.parquet(f"{path}/out").filter("kind = 'committed'").collect()]
    assert sorted(got) == [n * 10 + t for n in range(2) for t in range(9)]
    with pytest.raises(ValueError), progress.plain_logs(spark, path):
        raise ValueError
    assert spark.conf.get(progress.MANAGER, None) is None
    spark.conf.set(progress.MANAGER, "own.Choice")
    with progress.plain_logs(spark, path):
        assert spark.conf.get(progress.MANAGER) == "own.Choice"
    spark.conf.unset(progress.MANAGER)
