"""Hashes for which Spark has no built-in kernel, over whole Arrow batches at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reflected polynomial of CRC-64/ECMA as used with all-ones start and end.
ECMA = 0xC96C5795D7870F42
#: Bytes of a padded table of values: rows are taken by length, so that one long value does not widen all.
AREA = 16 << 20
_U32, _U64 = np.uint32, np.uint64


def _padded(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    raw = [b"" if v is None else bytes(v) for v in values]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.zeros((len(raw), int(size.max()) if len(raw) else 0), np.uint8)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
    return out, size


@lru_cache(maxsize=1)
def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        t = np.where(t & _U64(1), (t >> _U64(1)) ^ _U64(ECMA), t >> _U64(1))
    return t


def crc64_values(values: pd.Series) -> np.ndarray:
    """CRC-64/ECMA of each byte string; all rows take a byte a step."""
    data, size = _padded(values)
    table, crc = _crc_table(), np.full(len(data), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(data.shape[1]):
        on = size > i
        crc[on] = table[(crc[on] ^ data[on, i]) & _U64(0xFF)] ^ (crc[on] >> _U64(8))
    return ~crc


def murmur3_values(values: pd.Series, seed: int = 0) -> np.ndarray:
    """32-bit Murmur3 of each byte string (unsigned)."""
    data, size = _padded(values)
    data = np.pad(data, ((0, 0), (0, 4 + -data.shape[1] % 4)))
    words = data.view("<u4")
    c1, c2 = _U32(0xCC9E2D51), _U32(0x1B873593)
    rot = lambda x, r: (x << _U32(r)) | (x >> _U32(32 - r))
    h = np.full(len(data), seed, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(int(size.max() // 4) if len(size) else 0):
            on = size // 4 > i
            k = rot(words[on, i] * c1, 15) * c2
            h[on] = rot(h[on] ^ k, 13) * _U32(5) + _U32(0xE6546B64)
        tail = size % 4
        last = words[np.arange(len(size)), size // 4] if len(size) else h
        last = last & ((_U32(1) << (_U32(8) * tail.astype(np.uint32))) - _U32(1))
        h ^= np.where(tail > 0, rot(last * c1, 15) * c2, _U32(0))
        h ^= size.astype(np.uint32)
        h = (h ^ (h >> _U32(16))) * _U32(0x85EBCA6B)
        h = (h ^ (h >> _U32(13))) * _U32(0xC2B2AE35)
    return h ^ (h >> _U32(16))


def murmur3_64_values(values: pd.Series) -> np.ndarray:
    """First 64 bits of the 128-bit Murmur3 for 64-bit machines (unsigned), seed 0."""
    data, size = _padded(values)
    data = np.pad(data, ((0, 0), (0, 16 + -data.shape[1] % 16)))
    words = data.view("<u8")
    c1, c2 = _U64(0x87C37B91114253D5), _U64(0x4CF5AD432745937F)
    rot = lambda x, r: (x << _U64(r)) | (x >> _U64(64 - r))

    def mix(k):
        k = (k ^ (k >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
        k = (k ^ (k >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
        return k ^ (k >> _U64(33))

    h1, h2 = np.zeros(len(data), np.uint64), np.zeros(len(data), np.uint64)
    for i in range(int(size.max() // 16) if len(size) else 0):
        on = size // 16 > i
        a, b = h1[on] ^ (rot(words[on, 2 * i] * c1, 31) * c2), h2[on]
        a = (rot(a, 27) + b) * _U64(5) + _U64(0x52DCE729)
        b = b ^ (rot(words[on, 2 * i + 1] * c2, 33) * c1)
        h1[on], h2[on] = a, (rot(b, 31) + a) * _U64(5) + _U64(0x38495AB5)
    at = np.arange(len(size))
    if len(size):
        k1, k2 = words[at, size // 16 * 2], words[at, size // 16 * 2 + 1]  # zero beyond each row's bytes
        h1 ^= rot(k1 * c1, 31) * c2
        h2 ^= rot(k2 * c2, 33) * c1
    n = size.astype(np.uint64)
    h1, h2 = h1 ^ n, h2 ^ n
    h1 = h1 + h2
    h2 = h2 + h1
    return mix(h1) + mix(h2)


def by_length(kernel, values: pd.Series) -> np.ndarray:
    """The kernel's values in the order of the rows, from tables of at most AREA bytes or of one row."""
    size = np.fromiter((0 if v is None else len(v) for v in values), np.int64, len(values))
    order, out, at = np.argsort(size, kind="stable"), None, 0
    while at < len(order):
        to = len(order)
        while to - at > 1 and (to - at) * size[order[to - 1]] > AREA:
            to = at + max(1, min((to - at) // 2, AREA // int(size[order[to - 1]])))
        part = kernel(values.iloc[order[at:to]])
        out = np.empty(len(order), part.dtype) if out is None else out
        out[order[at:to]] = part
        at = to
    return kernel(values) if out is None else out


def _udf(kernel, kind: str, signed):
    def run(values: pd.Series) -> pd.Series:
        made = by_length(kernel, values)
        return pd.Series(made.view(signed) if signed else made.astype(np.int64)).where(values.notna().values, None).astype("Int64")

    return F.pandas_udf(run, kind)


def crc64(value: Column | str) -> Column:
    """CRC-64/ECMA of a binary column as the bit pattern of a BIGINT."""
    return _udf(crc64_values, "bigint", np.int64)(value)


def murmur3(value: Column | str) -> Column:
    """32-bit Murmur3 of a binary column, 0 to 2**32 - 1."""
    return _udf(murmur3_values, "bigint", None)(value)


def murmur3_64(value: Column | str) -> Column:
    return _udf(murmur3_64_values, "bigint", np.int64)(value)


def dispatch(key: Column | str, buckets: int) -> Column:
    """Bucket of a key, the same as programs that take Murmur3 modulo the number of buckets."""
    return F.pmod(murmur3(key), F.lit(buckets)).cast("int")


def span_id(start: Column, end: Column) -> Column:
    """Identifier of a range: both ends are hashed with their lengths, so that different ranges differ."""
    return F.xxhash64(F.length(start), start, F.length(end), end)
