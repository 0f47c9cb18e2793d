"""Sinks by scheme, and the queue's promise to take each batch once."""

import pyarrow as pa
import pytest
from keyloom.operators import changelog
from keyloom.streaming import apply, sinks

from .test_regions import Feed

LOG = "op_type int, key binary, value binary, crts bigint, sequence bigint"


def rows(lo, hi):
    out = [(1, bytearray(f"k{k}".encode()), bytearray(b"v"), k, k) for k in range(lo, hi)]
    return [*out, (changelog.RESOLVED, None, None, hi, hi)]


def started(spark, tmp_path, uri):
    stream = spark.readStream.schema(LOG).parquet(f"{tmp_path}/in")
    sinks.open_sink(stream, uri).option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()


def shown(queue):
    return sorted((r.partition, r.op_type, r.key and bytes(r.key), r.crts) for r in queue.collect())


def test_queue(spark, tmp_path):
    feed = Feed(spark, tmp_path, LOG, None)
    uri = f"QUEUE://{tmp_path}/q?partitions=4"
    feed.put(rows(0, 40))
    started(spark, tmp_path, uri)
    feed.put(rows(40, 60))
    started(spark, tmp_path, uri)
    queue = sinks.read_queue(spark, f"file://{tmp_path}/q")
    got = shown(queue)
    assert [(p, ts) for p, op, _, ts in got if op == changelog.RESOLVED] == [(p, ts) for p in range(4) for ts in (40, 60)]
    entries = {k: p for p, op, k, _ in got if op == changelog.PUT}
    assert len(entries) == 60 == sum(op == changelog.PUT for _, op, _, _ in got) and set(entries.values()) == set(range(4))
    want = {bytes(r.key): r.partition for r in sinks.dealt(spark.createDataFrame(rows(0, 60), LOG), 4).filter("op_type = 1").collect()}
    assert entries == want
    # a batch that fails leaves nothing; one that runs again after it was committed counts once
    writer = sinks.QueueWriter({"path": f"file://{tmp_path}/q"})
    batch = pa.RecordBatch.from_pylist([{"partition": p, "op_type": 1, "key": b"again", "value": b"v", "crts": 99, "sequence": 99} for p in (0, 1)], pa.schema([("partition", pa.int32()), ("op_type", pa.int32()), ("key", pa.binary()), ("value", pa.binary()), ("crts", pa.int64()), ("sequence", pa.int64())]))
    lost = writer.write(iter([batch]))
    assert shown(sinks.read_queue(spark, f"file://{tmp_path}/q")) == got
    writer.abort([lost, None], 2)
    assert not any((tmp_path / "q" / n).exists() for n in lost.names)
    for _ in range(2):
        writer.commit([writer.write(iter([batch])), None], 2)
    assert len(shown(sinks.read_queue(spark, f"file://{tmp_path}/q"))) == len(got) + 2


def test_other_sinks(spark, tmp_path):
    feed = Feed(spark, tmp_path, LOG, None)
    feed.put(rows(0, 5))
    started(spark, tmp_path, f"store://{tmp_path}/t?buckets=2")
    assert apply.StateTable(f"file://{tmp_path}/t", buckets=2).state(spark).count() == 5
    stream = spark.readStream.schema(LOG).parquet(f"{tmp_path}/in")
    query = sinks.open_sink(stream, "blackhole://").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/none").start()
    query.awaitTermination()
    assert sum(p["observedMetrics"]["dropped"]["rows"] for p in query.recentProgress if "dropped" in p["observedMetrics"]) == 6
    with pytest.raises(ValueError, match="unknown sink"):
        sinks.open_sink(stream, "ftp://x")
    with pytest.raises(ValueError, match="already"):
        sinks.register("Queue", sinks._queue)
    with pytest.raises(ValueError, match="compression"):
        sinks.open_sink(stream, "kafka://h:1/t?compression=odd")
    assert sinks.read_queue(spark, f"file://{tmp_path}/nothing").count() == 0
