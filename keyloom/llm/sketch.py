"""Count-min sketches of 64-bit keys: partial ones where the rows are, added up page by page, then tested for
counts above one, or read as magnitudes of counts. An estimate is never too small, so a key that it counts once does
occur once."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Counters of each of the sketch's rows, as a power of two (a bit each when broadcast: 16 MB a row at most),
#: and of a page, the part of a row that one task adds up.
SKETCH_BITS, PAGE_BITS = 27, 20
_ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_KEYS_HELD = 1 << 20
_U = np.uint64


def _slots(keys: np.ndarray, bits: int):
    return [((keys * _U(m)) >> _U(64 - bits)).astype(np.int64) for m in _ROWS]


def _partial(keys_of, bits: int):
    """A partition's counters, page by page: the slots counted once and those counted more often."""
    kind = pa.schema([("page", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])

    def pages(keys):
        for r, slot in enumerate(_slots(keys, bits)):
            slot, n = np.unique(slot, return_counts=True)
            cut = np.flatnonzero(np.diff(slot >> PAGE_BITS) > 0) + 1
            for part, many in zip(np.split(slot, cut), np.split(n > 1, cut), strict=True):
                low = (part & ((1 << PAGE_BITS) - 1)).astype("<u4")
                yield {"page": (r << 40) | int(part[0] >> PAGE_BITS), "once": low[~many].tobytes(), "more": low[many].tobytes()}

    def run(batches):
        held, n = [], 0
        for keys in keys_of(batches):
            held.append(keys)
            n += len(keys)
            if n > _KEYS_HELD:
                yield pa.RecordBatch.from_pylist(list(pages(np.concatenate(held))), kind)
                held, n = [], 0
        if n:
            yield pa.RecordBatch.from_pylist(list(pages(np.concatenate(held))), kind)

    return run


def _added(batches):
    """Sum of the partitions' counters, from rows sorted by page: the slots of a page counted more than once,
    as packed, compressed bits. One page of counters is held at a time."""
    page, count = None, np.zeros(1 << PAGE_BITS, np.uint8)
    kind = pa.schema([("page", pa.int64()), ("bits", pa.binary())])

    def made():
        more = count > 1
        return [{"page": page, "bits": zlib.compress(np.packbits(more).tobytes(), 1)}] if more.any() else []

    for b in batches:
        for p, once, more in zip(b.column("page").to_pylist(), b.column("once").to_pylist(), b.column("more").to_pylist(), strict=True):
            if p != page:
                if page is not None:
                    yield pa.RecordBatch.from_pylist(made(), kind)
                page = p
                count[:] = 0
            at = np.frombuffer(once, "<u4")
            count[at] = np.minimum(count[at] + 1, 2)
            count[np.frombuffer(more, "<u4")] = 2
    if page is not None:
        yield pa.RecordBatch.from_pylist(made(), kind)


def repeated_slots(rows: DataFrame, keys_of, bits: int = SKETCH_BITS) -> dict[int, bytes]:
    """The pages of slots that are counted more than once; keys_of maps record batches of `rows` to arrays of
    keys. At most 2 * 2**bits bits, whatever the input's size."""
    partial = rows.mapInArrow(_partial(keys_of, bits), "page bigint, once binary, more binary")
    added = partial.repartition("page").sortWithinPartitions("page").mapInArrow(_added, "page bigint, bits binary")
    return {r.page: bytes(r.bits) for r in added.collect()}


class Repeated:
    """Tests keys against the pages of repeated_slots."""

    def __init__(self, pages: dict[int, bytes], bits: int = SKETCH_BITS):
        self.bits, self.marks = bits, [np.zeros(1 << (bits - 3), np.uint8) for _ in _ROWS]
        for p, raw in pages.items():
            part = np.frombuffer(zlib.decompress(raw), np.uint8)
            at = (p & ((1 << 40) - 1)) << (PAGE_BITS - 3)
            row = self.marks[p >> 40]
            row[at : at + len(part)] = part[: len(row) - at]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), bool)
        for m, slot in zip(self.marks, _slots(keys, self.bits), strict=True):
            ok &= (m[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
        return ok


def _totals(keys_of, bits: int):
    """A partition's counts, page by page, saturated at 65535."""
    low, size = min(bits, PAGE_BITS), 1 << min(bits, PAGE_BITS)

    def run(batches):
        count = [np.zeros(1 << bits, np.uint16) for _ in _ROWS]

        def add(held):
            for c, slot in zip(count, _slots(np.concatenate(held), bits), strict=True):
                at, n = np.unique(slot, return_counts=True)
                c[at] = np.minimum(c[at] + n, 65535)

        held, n = [], 0
        for keys in keys_of(batches):
            held.append(keys)
            n += len(keys)
            if n > _KEYS_HELD:
                add(held)
                held, n = [], 0
        if held:
            add(held)
        for r, c in enumerate(count):
            for k in range(1 << (bits - low)):
                part = c[k * size : (k + 1) * size]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"page": pa.array([(r << 40) | k], pa.int64()), "counts": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})

    return run


def _magnitudes(batches):
    """Of rows sorted by page: the binary logarithms of the pages' total counts, compressed. One page is held."""
    page, total = None, None

    def made():
        log = np.ceil(np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int64()), "logs": pa.array([zlib.compress(log.tobytes(), 1)], pa.binary())})

    for b in batches:
        for p, raw in zip(b.column("page").to_pylist(), b.column("counts").to_pylist(), strict=True):
            if p != page:
                if page is not None:
                    yield made()
                page, total = p, 0
            total = total + np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.int64)
    if page is not None:
        yield made()


def magnitudes(rows: DataFrame, keys_of, bits: int) -> dict[int, bytes]:
    """The pages of binary logarithms of all keys' counts: 2 * 2**bits bytes at most, before compression."""
    partial = rows.mapInArrow(_totals(keys_of, bits), "page bigint, counts binary")
    added = partial.repartition("page").sortWithinPartitions("page").mapInArrow(_magnitudes, "page bigint, logs binary")
    return {r.page: bytes(r.logs) for r in added.collect()}


class Magnitudes:
    """Binary logarithms of keys' counts, rounded up, from the pages of magnitudes."""

    def __init__(self, pages: dict[int, bytes], bits: int):
        self.bits, self.logs = bits, [np.zeros(1 << bits, np.uint8) for _ in _ROWS]
        for p, raw in pages.items():
            part, at = np.frombuffer(zlib.decompress(raw), np.uint8), (p & ((1 << 40) - 1)) << min(bits, PAGE_BITS)
            self.logs[p >> 40][at : at + len(part)] = part

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return np.minimum.reduce([x[slot] for x, slot in zip(self.logs, _slots(keys, self.bits), strict=True)])
