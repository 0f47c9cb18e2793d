"""Manifests of backups as tables of sealed documents, written and read by executors.

A document is JSON lines of files, of a bounded size, with its SHA-256; encrypted ones are a random start vector and the
lines in counter mode."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.ctr import BLOCK, ctr

#: Bytes of JSON in a document.
DOCUMENT_BYTES = 4 << 20
_DOCUMENT = "first string, sha256 string, files bigint, iv binary, raw binary"


def _documents(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, size, first = [], 0, None

        def made():
            raw = "\n".join(lines).encode()
            row = {"first": first, "sha256": hashlib.sha256(raw).hexdigest(), "files": len(lines), "iv": os.urandom(BLOCK), "raw": raw}
            return pa.RecordBatch.from_pylist([row], pa.schema([("first", pa.string()), ("sha256", pa.string()), ("files", pa.int64()), ("iv", pa.binary()), ("raw", pa.binary())]))

        for b in batches:
            for name, line in zip(b.column("name").to_pylist(), b.column("line").to_pylist(), strict=True):
                if lines and size + len(line) > limit:
                    yield made()
                    lines, size = [], 0
                first = name if not lines else first
                lines.append(line)
                size += len(line) + 1
        if lines:
            yield made()

    return run


def write_manifest(files: DataFrame, path: str, key: bytes | None = None, limit: int = DOCUMENT_BYTES) -> None:
    """Write the files of a backup (name and any other columns) as documents; with a key they are encrypted. Files of
    any number: each task writes the documents of its range of names."""
    lines = files.select("name", F.to_json(F.struct(*files.columns), {"ignoreNullFields": "false"}).alias("line"))
    made = lines.repartitionByRange("name").sortWithinPartitions("name").mapInArrow(_documents(limit), _DOCUMENT)
    sealed = F.col("raw") if key is None else F.concat("iv", ctr(F.col("raw"), F.lit(key), F.col("iv")))
    made.select("first", "sha256", "files", F.lit(key is not None).alias("encrypted"), sealed.alias("sealed")).write.mode("errorifexists").parquet(path)


def read_manifest(spark: SparkSession, path: str, schema: str, key: bytes | None = None) -> DataFrame:
    """The files that a manifest names, with the columns of a schema. A document that has not its hash, and so a wrong
    key, is an error; so is an encrypted one without a key."""
    docs = spark.read.parquet(path)
    body = F.expr(f"substring(sealed, {BLOCK + 1})")
    opened = F.raise_error(F.lit("the manifest is encrypted")).cast("binary") if key is None else ctr(body, F.lit(key), F.expr(f"substring(sealed, 1, {BLOCK})"))
    raw = docs.select("sha256", F.when(F.col("encrypted"), opened).otherwise(F.col("sealed")).alias("raw"))
    text = F.when(F.sha2("raw", 256) == F.col("sha256"), F.decode("raw", "UTF-8")).otherwise(F.raise_error(F.lit("a document of the manifest is damaged or the key is wrong")).cast("string"))
    return raw.select(F.explode(F.split(text, "\n")).alias("line")).select(F.from_json("line", schema).alias("f")).select("f.*")


def read_bytes(spark: SparkSession, path: str, start: int, size: int, key: bytes) -> DataFrame:
    """(first, raw): the bytes [start, start + size) of every encrypted document, without the rest of it."""
    docs = spark.read.parquet(path).filter("encrypted")
    body = F.expr(f"substring(sealed, {BLOCK + 1 + start}, {size})")
    return docs.select("first", ctr(body, F.lit(key), F.expr(f"substring(sealed, 1, {BLOCK})"), start).alias("raw"))
