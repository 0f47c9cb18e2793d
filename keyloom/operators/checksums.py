"""Order-independent checksums of key-value sets, and reconciliation of two sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.functions.hashes import crc64


def checksum(pairs: DataFrame, *by: str, v2: bool = True) -> DataFrame:
    """crc64_xor, total_kvs, total_bytes. Keys count in the second format (with its prefix) unless v2 is False;
    the XOR does not depend on order and merges like a sum, so partial results never move rows."""
    key = K.encode_v2("key") if v2 else F.col("key")
    value = F.coalesce("value", F.lit(b""))
    each = pairs.select(*by, crc64(F.concat(key, value)).alias("crc"), (F.length(key) + F.length(value)).alias("bytes"))
    return each.groupBy(*by).agg(F.coalesce(F.bit_xor("crc"), F.lit(0).cast("bigint")).alias("crc64_xor"), F.count("*").alias("total_kvs"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"))


def merged(parts: DataFrame, *by: str, crc: str = "crc64xor") -> DataFrame:
    """Checksums of disjoint parts, such as files, added up without reading their rows."""
    return parts.groupBy(*by).agg(F.bit_xor(crc).alias("crc64_xor"), F.sum("total_kvs").cast("bigint").alias("total_kvs"), F.sum("total_bytes").cast("bigint").alias("total_bytes"))


def equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether two checksums of one row each agree."""
    names = ("crc64_xor", "total_kvs", "total_bytes")
    left, right = a.select(F.struct(*names).alias("a")), b.select(F.struct(*names).alias("b"))
    return left.crossJoin(right).select((F.col("a") == F.col("b")).alias("equal"))  # a row each


def differences(source: DataFrame, target: DataFrame, *keys: str) -> DataFrame:
    """Keys whose values differ or that one side lacks, with what is wrong: missing, extra or changed."""
    keys = keys or ("key",)
    rest = lambda df, name: df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c not in keys]))).alias(name))
    both = rest(source, "s").join(rest(target, "t"), list(keys), "full_outer")
    wrong = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").when(F.col("s") != F.col("t"), "changed")
    return both.select(*keys, wrong.alias("difference")).filter("difference is not null")


def set_hash(rows: DataFrame, *columns: str) -> Column:
    """XOR of the CRC-32 of each row's text: equal for equal sets in any order."""
    return F.bit_xor(F.crc32(F.concat_ws("\x1f", *columns).cast("binary")))
