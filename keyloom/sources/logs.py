"""Change logs as batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import codec, timestamps
from keyloom.operators import changelog

LOG_SCHEMA = "op_type int, key binary, value binary, old_value binary, start_ts bigint, crts bigint, expired_ts bigint, region_id bigint, keyspan_id bigint, sequence bigint"


def feed_rows(raw: DataFrame, old_values: bool = True) -> DataFrame:
    """Rows of a feed with op codes put and delete ("op") as entries; other codes raise an error, and old values
    go unless they are wanted."""
    op = F.when(F.col("op") == "put", changelog.PUT).when(F.col("op") == "delete", changelog.DELETE).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("NULL")))).cast("int"))
    old = F.col("old_value") if old_values else F.lit(None).cast("binary")
    return raw.withColumns({"op_type": op, "old_value": old}).drop("op")


def changes_of_events(events: DataFrame) -> DataFrame:
    """An events table (event_id, ts, user_id, event_type, value) as a change log: the user is the key, errors
    are deletes, and an entry expires as many seconds after its time as its value says."""
    micros = timestamps.micros("ts")
    return events.select(
        F.when(F.col("event_type") == "error", changelog.DELETE).otherwise(changelog.PUT).alias("op_type"), "user_id",
        F.encode(F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 8, "0")), "UTF-8").alias("key"),
        F.encode(F.concat_ws(":", "event_type", F.col("event_id").cast("string")), "UTF-8").alias("value"),
        micros.alias("crts"), F.col("event_id").alias("sequence"), (F.expr("cast(floor(value) as bigint)") + F.expr(f"{_MICROS} div 1000000")).alias("expired_ts"), "event_type", "event_id",
    )


_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def stream_files(spark: SparkSession, path: str, schema: str = LOG_SCHEMA, files_per_batch: int = 100) -> DataFrame:
    """A growing folder of Parquet files as a stream; each batch takes so many new files at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str, per_batch: int = 1_000_000) -> DataFrame:
    """A topic of messages of the open format as a stream (needs Spark's Kafka connector)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("maxOffsetsPerTrigger", per_batch).load()
    return codec.decode(raw.select("partition", "offset", "key", "value"), "partition", "offset")


def kafka_rows(log: DataFrame, partitions: int, by: str = "partition") -> DataFrame:
    """Messages of a log for a queue of so many partitions, dealt by key, ready for Spark's Kafka writer."""
    from keyloom.functions import hashes

    return codec.encode(log.withColumn(by, hashes.dispatch("key", partitions)), by)
