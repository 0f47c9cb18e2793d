"""Operator 8: token ids in binary files, packed by Simple-8b.

A file is a row of segments and a footer with their places. A segment holds whole documents: their ids and
token counts, 64-bit words whose top four bits select how many values of how many bits follow, the place of
every block's first word, and the values that no selector can hold (escapes)."""

from __future__ import annotations

import struct
import uuid
from array import array
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounded_batches, slices
from .pretokens import as_letters, pretokens, tokenizers_classes

#: Fixed values of the format: by selector, how many values a word holds, and of how many bits each.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 14  # the word's 60 bits are the value's place among the escapes
BLOCK = 256
_U = np.uint64
_HEAD, _MAGIC = struct.Struct("<4sIQQQQ"), b"S8BK"
#: Pre-tokens whose ids a worker remembers.
MEMO = 400_000


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit words, the index of each block's first word, and the escapes of a row of unsigned integers.

    Each block of BLOCK values is packed greedily by itself; all blocks advance together, a word a round."""
    n = len(values)
    blocks = -(-n // BLOCK)
    wide = np.zeros((blocks, BLOCK + 60), _U)
    full = np.zeros(blocks * BLOCK, _U)
    full[:n] = values
    wide[:, :BLOCK] = full.reshape(blocks, BLOCK)
    width = np.maximum(np.frexp(wide.astype(np.float64))[1], 0).astype(np.uint8)
    tops = [width]  # the widest of the next 1, 2, 4, ... values
    for k in range(5):
        t, step = tops[-1], 1 << k
        up = t.copy()
        up[:, :-step] = np.maximum(t[:, :-step], t[:, step:])
        tops.append(up)
    choice = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    for sel in range(ESCAPE):  # where one fits, all later ones do: they hold fewer and wider values
        c = int(COUNTS[sel])
        k = c.bit_length() - 1
        shift = c - (1 << k)
        most = np.maximum(tops[k][:, :BLOCK], tops[k][:, shift : shift + BLOCK])
        choice -= most <= BITS[sel]
    size = np.full(blocks, BLOCK)
    if blocks:
        size[-1] = n - (blocks - 1) * BLOCK
    at, live, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):
        sel = choice[live, at[live]]
        steps.append((live, at[live], sel))
        at[live] += COUNTS[sel]
        live = live[at[live] < size[live]]
    if not steps:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, _U)
    block = np.concatenate([s[0] for s in steps])
    order = np.argsort(block, kind="stable")
    block, pos, sel = block[order], np.concatenate([s[1] for s in steps])[order], np.concatenate([s[2] for s in steps])[order]
    words, flat = sel.astype(_U) << _U(60), wide.reshape(-1)
    base = block * (BLOCK + 60) + pos
    for s in np.unique(sel):
        rows = np.flatnonzero(sel == s)
        if s == ESCAPE:
            escapes = flat[base[rows]]
            words[rows] |= np.arange(len(rows), dtype=_U)
            continue
        for i in range(int(COUNTS[s])):
            words[rows] |= flat[base[rows] + i] << _U(i * int(BITS[s]))
    return words, np.searchsorted(block, np.arange(blocks)), escapes if ESCAPE in sel else np.zeros(0, _U)


def unpack(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values that pack() was given."""
    out = np.zeros(n, _U)
    if not n:
        return out
    sel = (words >> _U(60)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(COUNTS[sel])])
    block = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(words)]])))
    at = block * BLOCK + before[:-1] - before[first][block]
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(sel):
        rows = np.flatnonzero(sel == s)
        w = words[rows]
        if s == ESCAPE:
            out[at[rows]] = escapes[(w & _U((1 << 60) - 1)).astype(np.int64)]
            continue
        bits = int(BITS[s])
        for i in range(int(COUNTS[s])):
            to = at[rows] + i
            ok = to < end[rows]
            out[to[ok]] = (w[ok] >> _U(i * bits)) & _U((1 << bits) - 1)
    return out


def segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment of the file: documents (64-bit ids or None) with so many token ids each."""
    words, first, escapes = pack(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    head = _HEAD.pack(_MAGIC, BLOCK, len(keys), len(ids), len(words), len(escapes))
    return b"".join([head, keys.tobytes(), null.tobytes(), lengths.astype("<u8").tobytes(), first.astype("<u8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def read_segment(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    magic, block, docs, n, n_words, n_escapes = _HEAD.unpack_from(raw)
    if magic != _MAGIC or block != BLOCK:
        raise ValueError("not a segment of a token file")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(raw, kind, count, at)
        at += part.nbytes
        return part

    keys, null, lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
    first, words, escapes = take("<u8", -(-n // BLOCK)), take("<u8", n_words), take("<u8", n_escapes)
    return [None if z else k for k, z in zip(keys.tolist(), null, strict=True)], lengths.astype(np.int64), unpack(words, first.astype(np.int64), escapes, n)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """The library's ids of whole texts: its model merges each distinct pre-token once while the memo holds it."""

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.seen: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str]:
        """Pre-tokens, and the special strings, which are tokens wherever they stand."""
        parts = [text]
        for s in sorted(self.special, key=lambda s: (-len(s), s)):
            if s in text:
                parts = [x for p in parts for x in ([p] if p in self.special else [y for z in p.split(s) for y in (s, z)][1:])]
        if len(parts) == 1 and text not in self.special:
            return pretokens(text, tokenizers_classes)
        return [x for p in parts for x in ([p] if p in self.special else pretokens(p, tokenizers_classes))]

    def _merged(self, piece: str) -> bytes:
        known = self.seen.get(piece)
        if known is None:
            known = array("I", [self.special[piece]] if piece in self.special else [t.id for t in self.tok.model.tokenize(as_letters(piece))]).tobytes()
            if len(piece) <= 200:
                self.seen[piece] = known
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.seen) > MEMO:  # the first half has the most frequent ones, as they come early
            self.seen = dict(islice(self.seen.items(), MEMO // 2))
        out = []
        for text in texts:
            pieces = self._split(text)
            found = list(map(self.seen.get, pieces))
            if None in found:
                found = [self._merged(p) if k is None else k for p, k in zip(pieces, found, strict=True)]
            out.append(b"".join(found))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """A worker's own, whose memo lasts over its tasks."""
    return Encoder(path)


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, end_id: int = 2) -> list[tuple[str, int, int]]:
    """Write token files below `path` (a URI that driver and executors share) in ascending order of id, each
    document with end_id appended. Returns (file, documents, ids) for each file, in order: a few numbers a file.

    A null text counts as empty; rows of equal id (nulls come first) are ordered by a hash of their text and
    are all written. One shuffle, by ranges of the id. A task that runs again writes another file; only the
    files that are returned count."""
    tok_path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))

    def write(batches):
        encoder, out, name, places, n_docs, n_ids = _encoder(tok_path), None, "", [], 0, 0
        for b in slices(batches, "text"):
            if out is None:
                store, top = fs.FileSystem.from_uri(path)
                store.create_dir(top, recursive=True)
                name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.s8b"
                out = store.open_output_stream(f"{top}/{name}")
            made = [e + end for e in encoder.encode(b.column("text").to_pylist())]
            ids = np.frombuffer(b"".join(made), "<u4")
            raw = segment(b.column("id").to_pylist(), np.array([len(m) // 4 for m in made]), ids)
            places.append((out.tell(), len(raw)))
            out.write(raw)
            n_docs, n_ids = n_docs + len(made), n_ids + len(ids)
        if out is not None:
            out.write(b"".join(struct.pack("<QQ", *p) for p in places) + struct.pack("<Q", len(places)))
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "file": name, "docs": n_docs, "ids": n_ids}])

    made = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").mapInArrow(write, "part bigint, file string, docs bigint, ids bigint").collect()
    return [(r.file, r.docs, r.ids) for r in sorted(made, key=lambda r: r.part)]


def read_token_files(spark: SparkSession, path: str, files: list[tuple[str, int, int]], id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), ids (binary, little-endian
    unsigned 32-bit). A task reads a file, a segment at a time."""
    starts = [0, *accumulate(n for _, _, n in files)][:-1]
    rows = [(name, start) for (name, _, _), start in zip(files, starts, strict=True)]

    def read(batches):
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                store, top = fs.FileSystem.from_uri(path)
                with store.open_input_file(f"{top}/{name}") as f:
                    size = f.size()
                    count = struct.unpack("<Q", f.read_at(8, size - 8))[0]
                    table = f.read_at(16 * count, size - 8 - 16 * count)
                    for place, length in struct.iter_unpack("<QQ", table):
                        keys, lengths, ids = read_segment(f.read_at(length, place))
                        ends = np.cumsum(lengths)
                        raw = ids.astype("<u4").tobytes()
                        cut = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(start + ends - lengths, pa.int64()), pa.array(cut, pa.binary())], names=["id", "start", "ids"])
                        start += len(ids)

    listed = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), "file string, start bigint")
    return listed.mapInArrow(read, "id bigint, start bigint, ids binary").withColumnRenamed("id", id_col)


def token_file_digests(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, start, n_tokens, ids_crc32 of what read_token_files gives."""
    return read.select(id_col, "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
