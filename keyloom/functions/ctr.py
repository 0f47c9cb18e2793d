"""AES in counter mode as a column function: any range of a stream can be encrypted or decrypted by itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

BLOCK = 16


def _counters(iv: bytes, first: int, n: int) -> bytes:
    """n blocks that count up from a start vector, as 128-bit big-endian numbers that wrap around."""
    start = (int.from_bytes(iv, "big") + first) % (1 << 128)
    high, low = divmod(start, 1 << 64)
    lows = np.uint64(low) + np.arange(n, dtype=np.uint64)
    highs = np.uint64(high) + (lows < np.uint64(low)).astype(np.uint64)
    return np.stack([highs, lows], 1).astype(">u8").tobytes()


@F.pandas_udf(BinaryType())
def _blocks(iv: pd.Series, offset: pd.Series, size: pd.Series) -> pd.Series:
    out = []
    for v, o, n in zip(iv, offset, size, strict=True):
        if v is None or pd.isna(o) or pd.isna(n):
            out.append(None)
            continue
        if len(v) != BLOCK:
            raise ValueError("a start vector has 16 bytes")
        first = int(o) // BLOCK
        out.append(_counters(bytes(v), first, -(-(int(o) + int(n)) // BLOCK) - first))
    return pd.Series(out, dtype=object)


@F.pandas_udf(BinaryType())
def _mixed(value: pd.Series, stream: pd.Series, offset: pd.Series) -> pd.Series:
    out = []
    for v, s, o in zip(value, stream, offset, strict=True):
        if v is None or s is None:
            out.append(None)
            continue
        at = int(o) % BLOCK
        out.append((np.frombuffer(v, np.uint8) ^ np.frombuffer(s, np.uint8)[at : at + len(v)]).tobytes())
    return pd.Series(out, dtype=object)


def ctr(value: Column, key: Column, iv: Column, offset: Column | int = 0) -> Column:
    """Bytes of a stream from `offset` on, encrypted or decrypted (which is the same) with a key of 16, 24 or 32 bytes
    and a start vector of 16. Spark has no counter mode: its cipher encrypts the counters, in blocks by themselves,
    and the stream is mixed in batches. Values are held whole, so long streams come as rows of pieces. A null is
    null, an empty value empty."""
    offset = F.lit(offset).cast("bigint") if isinstance(offset, int) else offset.cast("bigint")
    stream = F.aes_encrypt(_blocks(iv, offset, F.octet_length(value)), key, F.lit("ECB"), F.lit("PKCS"))
    return _mixed(value, stream, offset)
