"""Streaming application of change logs: every micro-batch is merged into a table by key.

A table is key-hash buckets of Parquet files and a manifest a version: a batch adds a delta to the buckets that it
touches, and reading takes the latest entry of each key over a bucket's base and deltas. A batch that is run again
after a failure writes the same delta and the same manifest again, so that each entry counts once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyloom.operators import changelog


class StateTable:
    """The latest entry of every key, deletes included, below a folder.

    A bucket with more than `compact_after` deltas is rewritten as one base, by the batch that makes it so many; the
    versions before the last `keep` (two or more, so that a batch can run again) go, with the files that only they
    name."""

    def __init__(self, path: str, *keys: str, buckets: int = 16, compact_after: int = 8, keep: int = 3):
        self.path, self.keys, self.buckets, self.compact_after, self.keep = path, keys or ("key",), buckets, compact_after, max(2, keep)

    def _store(self, spark: SparkSession, name: str):
        """The file system that holds the table, whatever Spark can write to, and a path in it."""
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(spark._jsc.hadoopConfiguration()), where

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        files, where = self._store(spark, folder)
        return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []

    def versions(self, spark: SparkSession) -> list[int]:
        return [int(n[:-5]) for n in self._names(spark, "manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, spark: SparkSession, n: int) -> dict:
        """Columns of a version, and for each bucket the folders of its base and deltas."""
        files, where = self._store(spark, f"manifests/{n:08d}.json")
        stream = files.open(where)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, spark: SparkSession, n: int, manifest: dict) -> None:
        """A manifest appears whole or not at all."""
        files, draft = self._store(spark, f"manifests/{n:08d}.draft")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        _, where = self._store(spark, f"manifests/{n:08d}.json")
        files.delete(where, False)
        if not files.rename(draft, where):
            raise OSError(f"cannot publish version {n} of {self.path}")

    def _write(self, rows: DataFrame, name: str) -> list[str]:
        """Write rows by bucket; the buckets that have some."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows.withColumn("state_bucket", bucket).repartition("state_bucket").write.partitionBy("state_bucket").mode("overwrite").parquet(f"{self.path}/data/{name}")
        return [n.split("=")[1] for n in self._names(rows.sparkSession, f"data/{name}") if n.startswith("state_bucket=")]

    def _read(self, spark: SparkSession, schema: StructType, buckets: dict[str, list[str]]) -> DataFrame:
        folders = [f"{self.path}/data/{name}/state_bucket={b}" for b, names in buckets.items() for name in names]
        rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
        return changelog.latest(rows, *self.keys).select(*schema.names)

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """For foreachBatch: version epoch is the one before it with the batch's entries. Only buckets with entries in
        the batch are written."""
        spark = batch.sparkSession
        entries = batch.filter(F.col("op_type").isin(changelog.PUT, changelog.DELETE))
        before = [n for n in self.versions(spark) if n < epoch]
        old = self.manifest(spark, before[-1])["buckets"] if before else {}
        delta = f"delta-{epoch:08d}"
        touched = self._write(changelog.latest(entries, *self.keys).select(*entries.columns), delta)
        buckets = {b: [*old.get(b, []), delta] for b in touched}
        full = {b: names for b, names in buckets.items() if len(names) > self.compact_after}
        if full:
            base = f"base-{epoch:08d}"
            self._write(self._read(spark, entries.schema, full), base)
            buckets |= {b: [base] for b in full}
        self._publish(spark, epoch, {"schema": entries.schema.json(), "buckets": old | buckets})
        self._vacuum(spark)

    def _vacuum(self, spark: SparkSession) -> None:
        there = self.versions(spark)
        kept = [self.manifest(spark, n) for n in there[-self.keep :]]
        used = {name for m in kept for names in m["buckets"].values() for name in names}
        files, _ = self._store(spark, "")
        for n in there[: -self.keep]:
            files.delete(self._store(spark, f"manifests/{n:08d}.json")[1], False)
        last = there[-1]
        for name in self._names(spark, "data"):
            if name not in used and int(name.split("-")[1]) <= last:
                files.delete(self._store(spark, f"data/{name}")[1], True)

    def version(self, spark: SparkSession, n: int) -> DataFrame | None:
        """The latest entries after a version that is kept."""
        if n not in self.versions(spark):
            return None
        m = self.manifest(spark, n)
        return self._read(spark, StructType.fromJson(json.loads(m["schema"])), m["buckets"])

    def state(self, spark: SparkSession, epoch: int | None = None) -> DataFrame:
        """What is there after a version, or the last: the keys whose last entry is a put."""
        return self.version(spark, self.versions(spark)[-1] if epoch is None else epoch).filter(F.col("op_type") == changelog.PUT)


def materialise(log: DataFrame, path: str, *keys: str) -> DataFrame:
    """Apply what a streaming log has now and return the state; a later call with the same path goes on from
    there. Progress is in the checkpoint beside the state."""
    table = StateTable(f"{path}/state", *keys)
    log.writeStream.foreachBatch(table.merge).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return table.state(log.sparkSession)


def released_stream(log: DataFrame, ts: str = "commit_time", delay: str = "3 seconds") -> DataFrame:
    """An event-time stream that gives entries up to a watermark behind the newest one, without repeats."""
    return log.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["key", "crts", "sequence"])


def black_hole(log: DataFrame, name: str = "dropped"):
    """A query that counts entries (in its progress, as `name`) and writes nothing."""
    return log.observe(name, F.count("*").alias("rows")).writeStream.format("noop")
