"""Operator 4: removal of repeated byte strings by external suffix sorting.

A string of `length` bytes has a key, the smallest hash of its grams; equal strings have equal keys, so the
texts fall into stretches of neighbouring strings with one key, and stretches of different keys share no
string. A count-min sketch leaves out keys that occur once. Equal stretches are counted by an aggregate: those
that occur more than once are repeated as a whole, and one of each goes on if another with its key occurs once.
The distinct stretches are dealt by key to shards, and each shard is sorted by external induced sorting: its suffixes with a common prefix of
`length` bytes or more with a neighbour are the repeated strings that only parts of stretches share."""

from __future__ import annotations

import tempfile
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_BASE, WORD_BASES, bounded_batches, flat_bytes, fmix, merged_intervals, powers, shared_dir, slices, sliding_argmin, window_hashes
from .induced import repeated_starts
from .sketch import SKETCH_BITS, Repeated, repeated_slots

#: Bytes of text looked at in one numpy step; longer texts are cut, with an overlap of length - 1.
PIECE = 1 << 18
#: Bytes of stretches that are sorted together; more only where they share a key.
SHARD = 2 << 20
#: No text in UTF-8 has this byte: it ends every stretch of a shard.
END = 0xFE
_U = np.uint64
#: A mixed hash of each byte, for grams and for stretches.
_BYTE_HASH = [fmix(np.arange(256, dtype=_U) + _U(c)) for c in (1, *(b & 0xFFFF for b in WORD_BASES))]


def _pieces(batches, length: int):
    """(row, texts' bytes, places of pieces): parts of slices in which all strings of `length` bytes start once.
    Yields (batch, row of each text, flat bytes, offsets of the texts in them, place of each in its text)."""
    for b in slices(batches, "text", PIECE):
        flat, offs = flat_bytes(b.column("text"))
        if len(flat) <= 2 * PIECE or b.num_rows > 1:
            yield b, flat, offs, 0
            continue
        for a in range(0, len(flat) - length + 1, PIECE):  # one long text
            part = flat[a : a + PIECE + length - 1]
            yield b, part, np.array([0, len(part)]), a


class Strings:
    """The strings of `length` bytes of some texts: where they start (at), in which text (row), their keys."""

    def __init__(self, flat: np.ndarray, offs: np.ndarray, length: int, gram: int):
        self.flat, self.offs = flat, offs
        row = np.repeat(np.arange(len(offs) - 1), np.maximum(0, np.diff(offs) - length + 1))
        n = np.maximum(0, np.diff(offs) - length + 1)
        self.at = np.arange(len(row)) + np.repeat(offs[:-1] - (np.cumsum(n) - n), n)
        self.row = row
        self.chosen, self.key = self.at, np.zeros(0, _U)
        if len(row):
            grams = window_hashes(_BYTE_HASH[0][flat], gram, BYTE_BASE)
            self.chosen = sliding_argmin(grams, length - gram + 1)[self.at]
            self.key = grams[self.chosen]

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First string and number of strings of each stretch of neighbours with the same key."""
        if not len(self.at):
            return self.at, self.at
        new = np.flatnonzero(np.concatenate([[True], (np.diff(self.chosen) != 0) | (np.diff(self.at) != 1)]))
        return new, np.diff(np.concatenate([new, [len(self.at)]]))


def _keys(length: int, gram: int):
    def run(batches):
        for _, flat, offs, _ in _pieces(batches, length):
            s = Strings(flat, offs, length, gram)
            first, _ = s.runs()
            yield s.key[first]

    return run


def _twice(batches):
    """The keys of a table, so that a sketch has each of them as a repeated one."""
    for b in batches:
        yield np.repeat(b.column("key").to_numpy().view(_U), 2)


def _stretches(length: int, gram: int, bits: int, pages: dict[int, bytes], with_bytes: bool):
    """A row a stretch whose key is in the sketch: hashes of its bytes, its place, its key, and the bytes if asked."""

    def run(batches):
        repeated = Repeated(pages, bits)
        for b, flat, offs, place in _pieces(batches, length):
            s = Strings(flat, offs, length, gram)
            first, size = s.runs()
            ok = repeated(s.key[first]) if len(first) else np.zeros(0, bool)
            first, size = first[ok], size[ok]
            if not len(first):
                continue
            start, row = s.at[first], s.row[first]
            end = start + size + length - 1
            marks = []
            for base, byte in zip(WORD_BASES, _BYTE_HASH[1:], strict=True):
                up, down = powers(base, len(flat) + 1)
                total = np.zeros(len(flat) + 1, _U)
                np.cumsum(byte[flat] * up[: len(flat)], out=total[1:])
                marks.append(fmix((total[end] - total[start]) * down[start] + (end - start).astype(_U)).view(np.int64))
            ids = [b.column(c).take(pa.array(row)) for c in ("id", "tie")]
            own = start - offs[row] + place
            cols = [*ids, pa.array(marks[0]), pa.array(marks[1]), pa.array(own), pa.array(size), pa.array(s.key[first].view(np.int64))]
            names = ["id", "tie", "r1", "r2", "start", "size", "key"]
            if with_bytes:
                cols += [pa.array([flat[x:y].tobytes() for x, y in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())]
                names += ["bytes"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


class Shard:
    """Stretches written one after the other to a file, to be sorted together."""

    def __init__(self, folder: Path, length: int):
        self.folder, self.length, self.path = folder, length, folder / "shard"
        self.own, self.at, self.file = [], 0, self.path.open("wb")

    def add(self, n: int, key: tuple, start: int, raw: bytes) -> None:
        self.file.write(raw)
        self.file.write(bytes([END]))
        self.own.append((self.at, n == 1, key, start))
        self.at += len(raw) + 1

    def repeated(self):
        """(id, tie, starts) of the strings that start in stretches which occur once and elsewhere in the shard."""
        self.file.close()
        if not self.own:
            return
        text = np.memmap(self.path, np.uint8, "r")
        begins, alone = np.array([o[0] for o in self.own]), np.array([o[1] for o in self.own])
        found = list(repeated_starts(text, self.length, self.folder))
        pos = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        row = np.searchsorted(begins, pos, side="right") - 1
        inside = pos + self.length < np.concatenate([begins[1:], [self.at]])[row]  # the end byte is outside
        pos, row = pos[inside & alone[row]], row[inside & alone[row]]
        cut = [0, *(np.flatnonzero(np.diff(row)) + 1).tolist(), len(pos)]
        for a, z in zip(cut, cut[1:], strict=False) if len(pos) else ():
            at, _, (id_, tie), start = self.own[row[a]]
            yield {"id": id_, "tie": tie, "starts": (pos[a:z] - at + start).tolist()}


def _sorted_shards(length: int):
    """Repeated strings of each partition of distinct stretches, a row a stretch. Rows come sorted by key; a
    stretch goes to a shard once another with its key has come. A shard ends with a key, beyond SHARD bytes."""
    kind = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("starts", pa.list_(pa.int64()))])

    def shards(batches, folder):
        shard, key, first = Shard(folder, length), None, None
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("key", "n", "id", "tie", "start", "bytes")), strict=True):
                stretch = (row[1], row[2:4], row[4], row[5])
                if row[0] != key:
                    if shard.at > SHARD:
                        yield shard
                        shard = Shard(folder, length)
                    key, first = row[0], stretch
                    continue
                if first is not None:
                    shard.add(*first)
                    first = None
                shard.add(*stretch)
        yield shard

    def run(batches):
        with tempfile.TemporaryDirectory() as folder:
            for shard in shards(batches, Path(folder)):
                rows = shard.repeated()
                while part := list(islice(rows, 5000)):
                    yield pa.RecordBatch.from_pylist(part, kind)

    return run


def _kept(length: int):
    """Texts without the removed bytes, from (id, text, covered spans)."""

    def run(batches):
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]
        for b in slices(batches, "text"):
            flat, offs = flat_bytes(b.column("text"))
            removed, spans, kept = [], [], []
            for lo, hi, covered in zip(offs[:-1].tolist(), offs[1:].tolist(), b.column("spans").to_pylist(), strict=True):
                text, n, parts = flat[lo:hi], 0, []
                if covered:
                    start = np.concatenate([np.asarray(x["starts"], np.int64) for x in covered])
                    size = np.concatenate([np.full(len(x["starts"]), x["size"], np.int64) for x in covered])
                    s, e = merged_intervals(start, start + size + length - 1)
                    n, at = int((e - s).sum()), 0
                    for x, y in zip(s.tolist(), e.tolist(), strict=True):
                        parts.append(text[at:x].tobytes())
                        at = y
                    parts.append(text[at:].tobytes())
                    spans.append(len(s))
                else:
                    parts.append(text.tobytes())
                    spans.append(0)
                removed.append(n)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(offs), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=names)

    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 64, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the bytes left).

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text too;
    strings are judged on the input and never cross texts. A null text is empty; texts shorter than `length`
    lose nothing. Repeated rows are places of their own, so each of them loses what they share, whatever their
    ids, null ones too. An empty table gives an empty result."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text"))
    pages = spark.sparkContext.broadcast(repeated_slots(rows, _keys(length, gram), sketch_bits))  # its size has a fixed bound

    def places(batches):
        yield from _stretches(length, gram, sketch_bits, pages.value, False)(batches)

    fields = "id bigint, tie bigint, r1 bigint, r2 bigint, start bigint, size bigint, key bigint"
    path = shared_dir(spark, "stretches")
    rows.mapInArrow(places, fields).write.parquet(path)
    there = spark.read.parquet(path)
    often = there.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min("key").alias("key"))
    # only a stretch that occurs once, beside others with its key, can be repeated in part
    mixed = often.groupBy("key").agg(F.count("*").alias("stretches"), F.min("n").alias("n")).filter("stretches > 1 and n = 1").select("key")
    wanted = spark.sparkContext.broadcast(repeated_slots(mixed, _twice, sketch_bits))  # as large as the other sketch

    def whole(batches):
        yield from _stretches(length, gram, sketch_bits, wanted.value, True)(batches)

    found = rows.mapInArrow(whole, f"{fields}, bytes binary")
    # of a stretch that occurs once, first() is that occurrence; of others, only what all have in common is used
    distinct = found.groupBy("r1", "r2").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("key", "id", "tie", "start", "bytes")])
    parts = distinct.select("key", "n", "id", "tie", "start", "bytes").repartition("key").sortWithinPartitions("key", "bytes")
    partly = parts.mapInArrow(_sorted_shards(length), "id bigint, tie bigint, starts array<bigint>").select("id", "tie", F.lit(1).cast("bigint").alias("size"), "starts")
    wholly = there.join(often.filter("n > 1").select("r1", "r2"), ["r1", "r2"]).select("id", "tie", "size", F.array("start").alias("starts"))
    spans = partly.union(wholly).distinct().groupBy("id", "tie").agg(F.collect_list(F.struct("size", "starts")).alias("spans"))
    spans = spans.withColumnRenamed("id", "i").withColumnRenamed("tie", "t").hint("shuffle_hash")
    met = rows.join(spans, F.col("id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")), "left").select("id", "text", "spans")
    return met.mapInArrow(_kept(length), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").withColumnRenamed("id", id_col)
