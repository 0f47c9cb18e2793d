"""Backups: range-partitioned files with metadata, selection and rewriting of files, verification."""

from __future__ import annotations

import base64
import hashlib
import json
import secrets
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators import checksums, ranges

FILE_FIELDS = "name string, cf string, start_key binary, end_key binary, total_kvs bigint, total_bytes bigint, crc64xor bigint, size bigint, sha256 binary"


def select_files(files: DataFrame, backed_up: DataFrame, start: bytes, end: bytes | None, cf: str = "default") -> DataFrame:
    """Files of the column family that a restore of [start, end) reads. The range must lie in one backed-up
    range (ValueError otherwise). A file whose exclusive end is the start is read too, as it always was."""
    low, high = F.lit(start), F.lit(end).cast("binary")
    holds = backed_up.filter((F.col("start") <= low) & (F.col("end").isNull() | (F.lit(end is not None) & (high <= F.col("end")))))
    if holds.isEmpty():
        raise ValueError("the range is not fully backed up")
    reach = F.col("end_key").isNull() | (F.col("end_key") >= low)
    return files.filter((F.col("cf") == cf) & reach & (F.lit(end is None) | (F.col("start_key") < F.coalesce(high, F.lit(b"")))))


def duplicate_names(files: DataFrame) -> DataFrame:
    return files.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")


def by_start(files: DataFrame) -> DataFrame:
    """Bytes, keys and file names of each start key; different ends of one start raise an error."""
    end = F.when(F.count_distinct(F.coalesce("end_key", F.lit(b""))) > 1, F.raise_error(F.lit("files of one start end differently")).cast("binary")).otherwise(F.max("end_key"))
    return files.groupBy("start_key").agg(end.alias("end_key"), F.sum("total_bytes").alias("total_bytes"), F.sum("total_kvs").alias("total_kvs"), F.sort_array(F.collect_set("name")).alias("names"))


def archive_size(files: DataFrame) -> DataFrame:
    return files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"))


def metadata_checksum(files: DataFrame) -> DataFrame:
    return checksums.merged(files)


def rewritten(rows: DataFrame, rules: DataFrame, column: str = "key") -> DataFrame:
    """Keys with their prefix replaced by the first matching rule (rule_no, old_prefix, new_prefix); a key
    without a rule stays. Rules are written by people; they are counted before they are broadcast."""
    if not ranges.small(rules):
        raise ValueError("too many rewrite rules")
    listed = rules.agg(F.array_sort(F.collect_list(F.struct("rule_no", "old_prefix", "new_prefix"))).alias("rules"))
    with_rules = rows.crossJoin(F.broadcast(listed))  # one row of rules
    first = F.get(F.filter("rules", lambda r: F.startswith(F.col(column), r["old_prefix"])), F.lit(0))
    new = F.concat(first["new_prefix"], F.substring(F.col(column), F.length(first["old_prefix"]) + 1, F.lit(2**31 - 1)))
    return with_rules.withColumn(column, F.coalesce(new, F.col(column))).drop("rules")


def shown(files: DataFrame) -> Column:
    """A file's metadata as JSON, byte strings in hex."""
    return F.to_json(F.struct("name", "cf", F.lower(F.hex("sha256")).alias("sha256"), F.lower(F.hex("start_key")).alias("start_key"), F.lower(F.hex("end_key")).alias("end_key"), "total_kvs", "total_bytes", "crc64xor"))


def backup(pairs: DataFrame, path: str, start: bytes = b"", end: bytes | None = None) -> DataFrame:
    """Write the pairs of a range as Parquet files by key ranges with metadata beside them; refuses a folder in
    use. Returns the metadata (a row a file), read back."""
    spark = pairs.sparkSession
    inside = pairs.filter(K.in_span("key", F.lit(start), F.lit(end).cast("binary")))
    dealt = inside.repartitionByRange("key").sortWithinPartitions("key")
    dealt.select("key", "value").write.mode("errorifexists").parquet(f"{path}/data")
    data = spark.read.parquet(f"{path}/data").withColumn("name", F.col("_metadata.file_name"))
    sums = checksums.checksum(data, "name").withColumnRenamed("crc64_xor", "crc64xor")
    bounds = data.groupBy("name").agg(F.min("key").alias("start_key"), F.max("key").alias("last"), F.first(F.col("_metadata.file_size")).alias("size"))
    w = Window.orderBy("start_key")  # a row a file
    meta = bounds.join(sums, "name").withColumn("end_key", F.lead("start_key").over(w)).withColumn("cf", F.lit("default"))
    meta.select("name", "cf", "start_key", "end_key", "total_kvs", "total_bytes", "crc64xor", "size").write.parquet(f"{path}/files")
    return spark.read.parquet(f"{path}/files")


def restore(spark: SparkSession, path: str, start: bytes = b"", end: bytes | None = None) -> DataFrame:
    """The pairs of a range from a backup, reading only the files that it needs."""
    files = spark.read.parquet(f"{path}/files")
    whole = spark.range(1).select(F.lit(b"").alias("start"), F.lit(None).cast("binary").alias("end"))
    names = select_files(files, whole, start, end).select("name")
    data = spark.read.parquet(f"{path}/data").withColumn("name", F.col("_metadata.file_name"))
    names = F.broadcast(names) if ranges.small(names) else names
    return data.join(names, "name", "left_semi").filter(K.in_span("key", F.lit(start), F.lit(end).cast("binary"))).select("key", "value")


def verify(spark: SparkSession, path: str) -> DataFrame:
    """One row: whether the data still have the checksum of the metadata."""
    data = checksums.checksum(spark.read.parquet(f"{path}/data"))
    return checksums.equal(data, metadata_checksum(spark.read.parquet(f"{path}/files")))


# Manifests: a small document on the driver, with child documents beyond a size, each sealed by its hash.

MANIFEST_BYTES = 128 << 20


def manifest(kind: dict, files: Iterator[dict], limit: int = MANIFEST_BYTES) -> dict[str, bytes]:
    """Documents by name: "manifest" with facts about the backup, and the files in it or, beyond the limit, in
    children that it names with their SHA-256."""
    parts, now, size = [], [], 0
    for f in files:
        row = {k: base64.b64encode(v).decode() if isinstance(v, bytes | bytearray) else v for k, v in f.items()}
        n = len(json.dumps(row))
        if now and size + n > limit:
            parts.append(now)
            now, size = [], 0
        now.append(row)
        size += n
    if not parts:
        return {"manifest": json.dumps(kind | {"files": now}).encode()}
    docs, children = {}, []
    for i, part in enumerate([*parts, now]):
        docs[f"manifest-{i:06d}"] = raw = json.dumps({"files": part}).encode()
        children.append({"name": f"manifest-{i:06d}", "sha256": hashlib.sha256(raw).hexdigest()})
    return docs | {"manifest": json.dumps(kind | {"children": children}).encode()}


def manifest_files(docs: dict[str, bytes], name: str = "manifest") -> Iterator[dict]:
    """The files of a document and its children, each checked against its hash."""
    doc = json.loads(docs[name])
    yield from doc.get("files", [])
    for child in doc.get("children", []):
        if hashlib.sha256(docs[child["name"]]).hexdigest() != child["sha256"]:
            raise ValueError(f"{child['name']} is damaged")
        yield from manifest_files(docs, child["name"])


def seal(value: Column, key: Column) -> Column:
    """Encrypt binary data with AES (16, 24 or 32 bytes of key); the random start vector comes before the data."""
    return F.aes_encrypt(value, key, F.lit("GCM"))


def unseal(value: Column, key: Column) -> Column:
    return F.aes_decrypt(value, key, F.lit("GCM"))


def new_key(bits: int = 256) -> bytes:
    return secrets.token_bytes(bits // 8)
