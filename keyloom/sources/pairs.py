"""Where key-value pairs come from: Parquet and CSV tables, decoded backups, generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import keys as K

PAIR_SCHEMA = "key binary, value binary"


def _binary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Text columns become bytes, a byte a character (ISO-8859-1); binary columns stay."""
    kind = dict(df.dtypes)
    as_bytes = lambda c: F.col(c) if kind[c] == "binary" else F.encode(F.col(c).cast("string"), "ISO-8859-1")
    return df.select(as_bytes(key).alias("key"), as_bytes(value).alias("value"))


def read_parquet(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    return _binary(spark.read.parquet(path), key, value)


def read_csv(spark: SparkSession, path: str, key: str = "key", value: str = "value", header: bool = True) -> DataFrame:
    return _binary(spark.read.csv(path, header=header, schema=None if header else f"{key} string, {value} string"), key, value)


def decode_v1(raw: DataFrame, ttl: bool = False) -> DataFrame:
    """Pairs of the first key format as backups hold them: a leading z goes, keys without it are skipped, and
    with ttl the last eight bytes of a value go. Expired pairs stay."""
    value = F.expr("substring(value, 1, length(value) - 8)") if ttl else F.col("value")
    return raw.filter(F.startswith("key", F.lit(b"z")) & (F.length("key") > 0)).select(F.substring("key", 2, 2**31 - 1).alias("key"), value.alias("value"))


def generated(spark: SparkSession, n: int, prefix: str = "", exact: bool = True, seed: int = 1, partitions: int | None = None, value: bytes = b"A" * 64) -> DataFrame:
    """n pairs: the prefix and sixteen digits, in sequence or drawn at random below 10**13."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    number = F.col("id") if exact else F.floor(F.rand(seed) * 10**13).cast("bigint")
    return ids.select(F.concat(F.lit(prefix), F.lpad(number.cast("string"), 16, "0")).cast("binary").alias("key"), F.lit(value).alias("value"))


def scan(pairs: DataFrame, start: bytes = b"", end: bytes | None = None, keys_only: bool = False) -> DataFrame:
    """The pairs of [start, end); the bounds and the columns reach the reader of the files."""
    inside = pairs.filter((F.col("key") >= F.lit(start)) & (F.lit(True) if end is None else F.col("key") < F.lit(end)))
    return inside.select("key") if keys_only else inside


def storage_uri(uri: str) -> str:
    """A storage URL in the spelling of Hadoop's file systems."""
    kind, sep, rest = uri.partition("://")
    if not sep:
        return f"file://{uri}"
    # Schemes and what Hadoop calls them.
    known = {"local": "file", "file": "file", "hdfs": "hdfs", "s3": "s3a", "gs": "gs", "gcs": "gs", "azure": "abfss", "azblob": "abfss"}
    if kind not in known:
        raise ValueError(f"unknown storage {kind!r}")
    return f"{known[kind]}://{rest}"


def in_v2(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("key", K.encode_v2("key"))
