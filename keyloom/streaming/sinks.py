"""Sinks of a feed by URI scheme, and a queue of files that takes every batch exactly once.

A queue is partitions of Parquet files and a manifest a batch. Tasks write files of their own, the driver names those
of a whole batch in its manifest, and readers see only what manifests name: a batch that failed leaves nothing, and
one that runs again replaces its manifest."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import parse_qs, urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.readwriter import DataStreamWriter

from keyloom.functions import hashes
from keyloom.operators import changelog
from keyloom.plans import feeds
from keyloom.sources import logs
from keyloom.streaming import apply

QUEUE = "partition int, op_type int, key binary, value binary, crts bigint, sequence bigint"
Opener = Callable[[DataFrame, str], DataStreamWriter]
_OPENERS: dict[str, Opener] = {}


def register(scheme: str, opener: Opener) -> None:
    """Let URIs of a scheme open what opener(log, uri) makes; a scheme is registered once."""
    if scheme.lower() in _OPENERS:
        raise ValueError(f"sink {scheme!r} is there already")
    _OPENERS[scheme.lower()] = opener


def open_sink(log: DataFrame, uri: str) -> DataStreamWriter:
    """The writer of a streaming log for a sink's URI; its scheme counts without case."""
    scheme = urlparse(uri).scheme.lower()
    if scheme not in _OPENERS:
        raise ValueError(f"unknown sink {scheme!r}; there are {', '.join(sorted(_OPENERS))}")
    return _OPENERS[scheme](log, uri)


def dealt(log: DataFrame, partitions: int) -> DataFrame:
    """Messages of a log for a queue: an entry goes to the partition of its key, a resolved marker to all."""
    everywhere = F.sequence(F.lit(0), F.lit(partitions - 1))
    to = F.when(F.col("op_type") == changelog.RESOLVED, everywhere).otherwise(F.array(hashes.dispatch("key", partitions).cast("int")))
    return log.select(F.explode(to).alias("partition"), "op_type", "key", "value", "crts", "sequence")


@dataclass
class _Files(WriterCommitMessage):
    names: list[str]


class QueueWriter(DataSourceStreamArrowWriter):
    """Files of a batch's tasks, and the manifest that makes them part of the queue."""

    def __init__(self, options):
        self.uri = options["path"]

    def _store(self):
        return fs.FileSystem.from_uri(self.uri)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        """A file for each partition that the task has rows of; row groups are written as batches come."""
        store, path = self._store()
        open_, names = {}, []
        try:
            for batch in iterator:
                parts = batch.column("partition")
                for p in parts.unique().to_pylist():
                    if p not in open_:
                        name = f"data/partition={p:05d}/{uuid.uuid4().hex}.parquet"
                        names.append(name)
                        store.create_dir(f"{path}/data/partition={p:05d}", recursive=True)
                        stream = store.open_output_stream(f"{path}/{name}")
                        open_[p] = (pq.ParquetWriter(stream, batch.schema), stream)
                    open_[p][0].write_batch(batch.filter(pc.equal(parts, p)))
        finally:
            for file, stream in open_.values():
                file.close()
                stream.close()
        return _Files(names)

    def commit(self, messages: list[_Files | None], batchId: int) -> None:
        store, path = self._store()
        names = sorted(n for m in messages if m is not None for n in m.names)
        store.create_dir(f"{path}/commits", recursive=True)
        draft = f"{path}/commits/.{batchId:012d}.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps({"batch": batchId, "files": names}).encode())
        store.move(draft, f"{path}/commits/{batchId:012d}.json")

    def abort(self, messages: list[_Files | None], batchId: int) -> None:
        """Remove the files of tasks that ended; those of others are named nowhere."""
        store, path = self._store()
        for m in messages:
            for n in m.names if m is not None else ():
                if store.get_file_info(f"{path}/{n}").type != fs.FileType.NotFound:
                    store.delete_file(f"{path}/{n}")


class QueueSink(DataSource):
    """Option: path."""

    @classmethod
    def name(cls) -> str:
        return "keyloom_queue"

    def schema(self) -> str:
        return QUEUE

    def streamWriter(self, schema, overwrite) -> QueueWriter:
        return QueueWriter(self.options)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a queue, from the files that its manifests name."""
    store, where = fs.FileSystem.from_uri(path)
    names = []
    for i in store.get_file_info(fs.FileSelector(f"{where}/commits", allow_not_found=True)):
        if i.base_name.endswith(".json"):
            with store.open_input_file(i.path) as f:
                names += json.loads(f.read())["files"]
    if not names:
        return spark.createDataFrame([], QUEUE)
    kept = QUEUE.split(", ", 1)[1]
    rows = spark.read.schema(f"{kept}, partition int").option("basePath", f"{path}/data").parquet(*[f"{path}/{n}" for n in names])
    return rows.select("partition", "op_type", "key", "value", "crts", "sequence")


def _options(uri: str) -> dict[str, str]:
    return {k: v[-1] for k, v in parse_qs(urlparse(uri).query).items()}


def _queue(log: DataFrame, uri: str) -> DataStreamWriter:
    log.sparkSession.dataSource.register(QueueSink)
    o = _options(uri)
    return dealt(log, int(o.get("partitions", 3))).writeStream.format("keyloom_queue").option("path", f"{o.get('fs', 'file')}://{urlparse(uri).path}")


def _store(log: DataFrame, uri: str) -> DataStreamWriter:
    o = _options(uri)
    table = apply.StateTable(f"{o.get('fs', 'file')}://{urlparse(uri).path}", buckets=int(o.get("buckets", 16)))
    return log.writeStream.foreachBatch(table.merge)


def _kafka(log: DataFrame, uri: str) -> DataStreamWriter:
    """Entries of each batch as packed messages, at least once; resolved markers need a message of their own."""
    options, partitions = feeds.kafka_options(uri), int(_options(uri).get("partition-num", 3))
    return log.filter(F.col("op_type") != changelog.RESOLVED).writeStream.foreachBatch(lambda batch, _: logs.kafka_rows(batch, partitions).write.format("kafka").options(**options).save())


register("blackhole", lambda log, uri: apply.black_hole(log))
register("queue", _queue)
register("store", _store)
register("kafka", _kafka)
register("kafka+ssl", _kafka)
