"""Operator 10: byte-level BPE encoding and decoding.

Distinct pre-tokens are laid out as rows of padded numpy matrices, one matrix for each range of lengths. In
every round each row merges its leftmost pair of lowest rank; pairs are looked up in an open-addressing hash
table, merged rows are compacted, and rows without a pair left leave the matrix."""

from __future__ import annotations

import base64
import hashlib
from collections import ChainMap
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices
from .pretokens import pretokens, tiktoken_classes

NONE = np.int32(0x7FFFFFFF)
_EMPTY = np.int64(-1)
#: Cells (rows times length) of a matrix at most, and encoded pre-tokens that a worker remembers.
CELLS, MEMO = 1 << 20, 400_000
#: From this length on, a row is merged by itself with a heap: in a matrix each merge would move the whole row.
LONG = 256
#: Pre-tokens of so many characters or more are not remembered, so that what a worker remembers has a bound.
REMEMBERED = 200


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """(left id, right id) -> id of the joined token: a hash table in two arrays, probed for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, out = [], [], []
        get = ranks.get
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), out.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        vals = np.array(out, np.int32)
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, _EMPTY)
        self.vals = np.full(1 << self.bits, NONE, dtype=np.int32)
        at, left_over = self._home(keys), np.arange(len(keys))
        while len(left_over):  # each free cell takes one of the keys that want it; the others step on
            cells = at[left_over]
            free = self.keys[cells] == _EMPTY
            first, where = np.unique(cells[free], return_index=True)
            take = left_over[free][where]
            self.keys[first], self.vals[first] = keys[take], vals[take]
            left_over = np.setdiff1d(left_over, take, assume_unique=True)
            at[left_over] = (at[left_over] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._home(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.vals[at], NONE)
        open_ = np.flatnonzero((got != keys) & (got != _EMPTY))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.vals[at[open_[hit]]]
            open_ = open_[~hit & (got != _EMPTY)]
        return out


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.table = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = {i: t for t, i in ranks.items()}
        self.seen: dict[str, bytes] = {}

    def _rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        n = len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, n)
        m = np.full((n, width), -1, np.int32)
        m[np.arange(width)[None, :] < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        done: list[np.ndarray | None] = [None] * n
        rows = np.arange(n)
        rank = np.full((n, width), NONE, np.int32)
        two = m[:, 1:] >= 0
        rank[:, :-1][two] = self.table.find(m[:, :-1][two], m[:, 1:][two])
        ids = np.arange(width)
        while len(rows):
            at = rank.argmin(1)
            low = rank[np.arange(len(rows)), at]
            over = low == NONE
            if over.any():
                for i in np.flatnonzero(over):
                    done[rows[i]] = m[i, : lens[i]]
                go = ~over
                rows, m, rank, lens, at, low = rows[go], m[go], rank[go], lens[go], at[go], low[go]
                if not len(rows):
                    break
                if (w := int(lens.max())) < 0.7 * m.shape[1]:  # narrower matrix once the longest row has shrunk
                    m, rank, ids = m[:, :w].copy(), rank[:, :w].copy(), ids[:w]
            r = np.arange(len(rows))
            m[r, at] = low
            take = np.minimum(ids[None, :] + (ids[None, :] > at[:, None]), m.shape[1] - 1)
            m, rank = np.take_along_axis(m, take, 1), np.take_along_axis(rank, take, 1)
            lens = lens - 1
            m[r, lens] = -1
            rank[ids[None, :] >= (lens - 1)[:, None]] = NONE
            for left in (at - 1, at):  # only the pairs beside the new token have changed
                ok = np.flatnonzero((left >= 0) & (left + 1 < lens))
                rank[ok, left[ok]] = self.table.find(m[ok, left[ok]], m[ok, left[ok] + 1])
        return done

    def _long(self, piece: bytes) -> np.ndarray:
        """One long row by itself: the pairs wait in a heap by rank and place, so that each merge looks at its two
        neighbours alone, and a row of n bytes takes n log n steps."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(self.table.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()) if r != NONE]
        heapify(heap)
        get = self.joined.get
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i], ids[j])) != rank:
                continue  # one of the pair has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((rank, ids[k]))) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get((ids[h], rank))) is not None:
                heappush(heap, (r, h))
        return np.array([x for x in ids if x >= 0], np.int32)

    @cached_property
    def joined(self) -> dict[tuple[int, int], int]:
        """(left id, right id) -> id of the joined token, for single look-ups."""
        full = self.table.keys != _EMPTY
        keys = self.table.keys[full]
        return dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist(), strict=True), self.table.vals[full].tolist(), strict=True))

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that is itself a token is that token."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) >= LONG:
                out[i] = self._long(p)
            elif p:
                groups.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
            else:
                out[i] = np.zeros(0, np.int32)
        for width, where in groups.items():
            step = max(1, CELLS // width)
            for a in range(0, len(where), step):
                part = where[a : a + step]
                for i, ids in zip(part, self._rows([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (int32)."""
        split = [pretokens(t, tiktoken_classes) for t in texts]
        if len(self.seen) > MEMO:  # the first half has the most frequent pieces, as they come early
            self.seen = dict(islice(self.seen.items(), MEMO // 2))
        new = list(set().union(*split) - self.seen.keys())
        long: dict[str, bytes] = {}
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            (self.seen if len(piece) < REMEMBERED else long)[piece] = ids.tobytes()
        get = (ChainMap(self.seen, long) if long else self.seen).__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), np.int32) for pieces in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _bpe(path: str) -> ByteBPE:
    return ByteBPE(read_ranks(path))


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """Per row: id, ids array<int>, decoded binary (the bytes that the ids stand for).

    A null or empty text gives no ids and no bytes; rows are kept as they are; other columns are not read."""
    return _mapped(docs, id_col, text_col, ranks_path, "ids array<int>, decoded binary", lambda ids, raw: (ids, raw))


def bpe_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256. Nulls as in bpe_encode."""
    text = {}

    def digest(ids, raw):
        for i in ids:
            if i not in text:
                text[i] = str(i)
        return len(ids), hashlib.sha256(",".join(map(text.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()

    return _mapped(docs, id_col, text_col, ranks_path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)


def _mapped(docs, id_col, text_col, ranks_path, fields, made):
    path = ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [f.split()[0] for f in fields.split(", ")]
    types = {"array<int>": pa.list_(pa.int32()), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
    kinds = [types[f.split()[1]] for f in fields.split(", ")]

    def encode(batches):
        bpe = _bpe(path)
        for b in slices(batches, "text"):
            made_rows = []
            for ids in bpe.encode_texts(b.column("text").to_pylist()):
                ids = ids.tolist()
                made_rows.append(made(ids, bpe.decode(ids)))
            cols = [pa.array(c, k) for c, k in zip(zip(*made_rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", *names])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, {fields}").withColumnRenamed("id", id_col)
