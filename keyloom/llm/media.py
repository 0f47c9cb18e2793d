"""Operator 6: media columns, as a Spark data source over archives.

Writing: every task writes one archive (ZIP, members stored as they are) with a PNG a row: 8-bit grey samples,
64 to a line, losslessly compressed. Reading: the planner cuts every archive into byte ranges without opening
it; a task reads the archive's directory, takes the members that start in its range and streams them in Arrow
batches. A member that cannot be read is tried again by itself, at its offset in a newly opened file."""

from __future__ import annotations

import hashlib
import io
import struct
import time
import uuid
import zipfile
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import bounded_batches

WIDTH = 64
#: Bytes of an archive that one task reads, of payload in a batch, and tries of a member.
RANGE, BATCH, TRIES = 32 << 20, 8 << 20, 3
_PNG = b"\x89PNG\r\n\x1a\n"
_LISTING = "archives.txt"


def padded(text: bytes) -> bytes:
    """The payload of a text: zero bytes are appended up to a positive multiple of 64."""
    n = max(1, -(-len(text) // WIDTH)) * WIDTH
    return text + bytes(n - len(text))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A grey image of 8-bit samples, 64 wide, without line filters."""
    rows = len(payload) // WIDTH
    lines = np.zeros((rows, WIDTH + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def from_png(raw: bytes) -> bytes:
    """The samples of an image that to_png() wrote; damaged files raise ValueError."""
    if raw[:8] != _PNG:
        raise ValueError("not a PNG")
    at, data, head = 8, [], None
    while at < len(raw):
        (n,), kind = struct.unpack_from(">I", raw, at), raw[at + 4 : at + 8]
        body = raw[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", raw, at + 8 + n)[0]:
            raise ValueError("damaged PNG")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    if head is None or head[0] != WIDTH or head[2:4] != (8, 0):
        raise ValueError("not an image of 64 grey samples a line")
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(head[1], WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("line filters are not used here")
    return lines[:, 1:].tobytes()


@dataclass
class Archive(WriterCommitMessage):
    """What a write task reports: the archive it has finished."""

    name: str | None
    size: int = 0


class MediaWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches) -> Archive:
        store, top = fs.FileSystem.from_uri(self.path)
        store.create_dir(top, recursive=True)
        name = f"media-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
        at = 0
        with store.open_output_stream(f"{top}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            for b in batches:
                for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    raw = text or b""
                    # the member's name carries what its samples do not: its row, its key and the length before padding
                    archive.writestr(zipfile.ZipInfo(f"{at:09d}.{'' if key is None else key}.{len(raw)}.png"), to_png(padded(raw)))
                    at += 1
        return Archive(name if at else None, store.get_file_info(f"{top}/{name}").size)

    def commit(self, messages) -> None:
        """The listing names the archives that count; those of lost or repeated tasks are not in it."""
        store, top = fs.FileSystem.from_uri(self.path)
        store.create_dir(top, recursive=True)
        with store.open_output_stream(f"{top}/{_LISTING}") as out:
            out.write("".join(f"{m.name} {m.size}\n" for m in messages if m and m.name).encode())

    def abort(self, messages) -> None:
        store, top = fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m and m.name:
                store.delete_file(f"{top}/{m.name}")


@dataclass
class ByteRange(InputPartition):
    name: str
    low: int
    high: int

    def __init__(self, name: str, low: int, high: int):
        self.name, self.low, self.high = name, low, high


class MediaReader(DataSourceReader):
    def __init__(self, path: str, step: int):
        self.path, self.step = path, step

    def partitions(self):
        store, top = fs.FileSystem.from_uri(self.path)
        with store.open_input_stream(f"{top}/{_LISTING}") as f:
            listed = [x.rsplit(" ", 1) for x in f.read().decode().splitlines()]
        return [ByteRange(name, low, min(low + self.step, int(size))) for name, size in listed for low in range(0, int(size), self.step)] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange):
        if not partition.name:
            return
        store, top = fs.FileSystem.from_uri(self.path)
        path, opened = f"{top}/{partition.name}", []

        def file(anew: bool):
            if anew or not opened:
                for f in opened:
                    f.close()
                opened[:] = [store.open_input_file(path)]
            return opened[0]

        with zipfile.ZipFile(io.BufferedReader(file(False), 1 << 16)) as z:
            members = [(m.header_offset, m.file_size, m.CRC, m.filename) for m in z.infolist() if partition.low <= m.header_offset < partition.high]
        opened.clear()  # closed with the directory
        rows, held = [], 0
        for offset, size, crc, name in sorted(members):
            media = read_member(file, offset, size, crc)
            _, key, n, _ = name.split(".")
            rows.append({"id": int(key) if key else None, "archive": partition.name, "offset": offset, "n_bytes": int(n), "media": media, "payload": from_png(media)})
            held += size + len(rows[-1]["payload"])
            if held >= BATCH:
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)


def read_member(file, offset: int, size: int, crc: int, tries: int = TRIES) -> bytes:
    """The bytes of the stored member whose header is at the offset. file(anew) gives the open archive, opened
    anew if asked; a failed read or a wrong checksum is tried again there, and only there."""
    for left in range(tries - 1, -1, -1):
        try:
            f = file(left < tries - 1)
            f.seek(offset)
            head = f.read(30)
            if len(head) != 30 or head[:4] != b"PK\x03\x04":
                raise OSError("no member here")
            f.seek(offset + 30 + sum(struct.unpack("<HH", head[26:30])))
            raw = f.read(size)
            if len(raw) != size or zlib.crc32(raw) != crc:
                raise OSError("the member's checksum is wrong")
            return raw
        except OSError:
            if not left:
                raise
            time.sleep(0.05)
    raise AssertionError


SCHEMA = pa.schema([("id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("payload", pa.binary())])


class MediaArchives(DataSource):
    """format("media_archives"): option path, a URI that driver and executors share; option rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return "id bigint, archive string, offset bigint, n_bytes bigint, media binary, payload binary"

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options["path"], int(self.options.get("rangeBytes", RANGE)))

    def writer(self, schema, overwrite: bool) -> MediaWriter:
        return MediaWriter(self.options["path"])


def write_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Archives of the rows' texts (UTF-8, padded; null: empty) below `path`. Every row becomes a member, repeated
    ids and null ids too; an empty table becomes an empty listing. No shuffle."""
    bounded_batches(docs.sparkSession)
    docs.sparkSession.dataSource.register(MediaArchives)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows.write.format("media_archives").mode("append").option("path", path).save()


def read_media(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """The members of the archives: id, archive, offset, n_bytes (before padding), media (the stored bytes),
    payload (the samples)."""
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").option("path", path).option("rangeBytes", range_bytes).load()


def _feature(payload: bytes) -> str:
    """Lines, mean and deviation of the samples, their number of values and entropy, and a 64-bit outline:
    which of 64 equal stretches of the samples are above the mean."""
    x = np.frombuffer(payload, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    p = p[p > 0]
    part = np.add.reduceat(x.astype(np.int64), np.arange(0, len(x), len(x) // 64))[:64] > x.mean() * (len(x) // 64)
    outline = int(np.packbits(part).view(">u8")[0])
    return f"lines={len(x) // WIDTH};mean={x.mean():.3f};dev={x.std():.3f};values={len(p)};entropy={-(p * np.log2(p)).sum():.4f};outline={outline:016x}"


def media_features(members: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per member: id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the last 64 samples), media_bytes,
    media_sha256, feature."""
    fields = "id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    kind = pa.schema([(f.split()[0], pa.int64() if f.endswith("bigint") else pa.string()) for f in fields.split(", ")])

    def run(batches):
        for b in batches:
            rows = []
            for key, n, media, payload in zip(*(b.column(c).to_pylist() for c in ("id", "n_bytes", "media", "payload")), strict=True):
                rows.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), _feature(payload)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)] if rows else [pa.array([], f.type) for f in kind], schema=kind)

    return members.select("id", "n_bytes", "media", "payload").mapInArrow(run, fields).withColumnRenamed("id", id_col)
