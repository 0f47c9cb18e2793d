"""Helpers that several operators share: shared folders, Arrow slices of texts, word positions and hashes."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step looks at; a longer text is a step of its own.
SLICE_BYTES = 4 << 20
#: Rows and bytes in an Arrow batch; whole texts travel in them, so the default of 10,000 rows is too many.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20

_U = np.uint64
#: Odd multipliers of the polynomial hashes (arbitrary fixed values).
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def _only_local(sc) -> None:
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Only where that setting is absent, as in local tests, is a temporary folder used."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not top:
        _only_local(sc)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        top = sc.getCheckpointDir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: lineage ends there and lost executors cost nothing."""
    sc = df.sparkSession.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        _only_local(sc)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small in this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batches, column: str, limit: int = SLICE_BYTES):
    """Cut record batches so that each slice holds at most `limit` bytes of `column`, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.diff(offsets_of(col))
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def offsets_of(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (nulls: none) and where each row starts and the last ends."""
    offs = offsets_of(col)
    data = col.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return flat, offs - offs[0]


def fmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        up = np.full(size, base, dtype=np.uint64)
        up[0] = 1
        down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 1 << 23:
            _POWERS[base] = have
    return have


def word_spans(flat: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (maximal runs of bytes for which is_word[byte]) of every row, and the
    index of the first word of each row (one more entry than rows). Words never cross rows."""
    inside = is_word[flat]
    edge = np.empty(len(flat) + 1, dtype=bool)
    edge[0] = len(flat) > 0 and inside[0]
    if len(flat):
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[-1] = inside[-1]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(flat))]
    cut = np.unique(cut[inside[cut] & inside[cut - 1]])  # a word ends and another starts between two rows
    marks = np.flatnonzero(edge)
    if len(cut):
        marks = np.sort(np.concatenate([marks, cut, cut]))
    starts, ends = marks[0::2], marks[1::2]
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A mixed 64-bit hash of each byte span; a function of its bytes alone. Every byte is mixed with its place, so
    that no algebra of the places makes spans collide, and with the seed, so that two seeds are independent."""
    total = np.zeros(len(flat) + 1, dtype=np.uint64)
    size = ends - starts
    at = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)  # the bytes inside spans
    place = (at - np.repeat(starts, size)).astype(np.uint64)
    mixed = np.zeros(len(flat), dtype=np.uint64)
    mixed[at] = fmix(place * _U(512) + flat[at] + _U((seed * 0xD6E8FEB86659FD93 + 1) & 0xFFFFFFFFFFFFFFFF))
    np.cumsum(mixed, out=total[1:])
    return fmix(total[ends] - total[starts] + size.astype(np.uint64))


def window_hashes(words: np.ndarray, k: int, base: int) -> np.ndarray:
    """A mixed hash of every k consecutive word hashes (rows are not looked at)."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(base, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    return fmix((total[k:] - total[:-k]) * down[: n - k + 1])


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the smallest of every w consecutive hashes, the last one of equals. Hashes are compared by
    their upper bits; the lower ones hold the position, so that one minimum finds both."""
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mask = _U((1 << max(20, len(values).bit_length())) - 1)
    best = (values | mask) - np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < w:
        step = min(span, w - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return (mask - (best & mask)).astype(np.int64)


def merged_intervals(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as sorted, disjoint, non-touching ones."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.empty(len(s), dtype=bool)
    new[0] = True
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.concatenate([at[1:] - 1, [len(s) - 1]])]


#: A key with more than one of so many rows is a hot one: fewer than that many keys are.
HOT = 1000


def join_by_hot_key(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows with the facts of their keys, which have one row a key, the number of its rows (many) and are written
    already. Keys that hold more than one of HOT rows are broadcast, fewer than HOT whatever the input; only the
    others are shuffled, so that no task gets a hot key's rows."""
    total = facts.agg(F.sum("many")).first()[0] or 0
    hot = F.col("many") * HOT > total
    rest = [c for c in facts.columns if c not in (key, "many")]
    few = facts.filter(hot).select(key, F.struct(*rest).alias("hot_facts"))
    marked = rows.join(F.broadcast(few), key, "left")
    near = marked.filter("hot_facts is not null").select(*rows.columns, "hot_facts.*")
    return near.union(marked.filter("hot_facts is null").select(*rows.columns).join(facts.filter(~hot).drop("many"), key).select(*rows.columns, *rest))
