"""The open message format of change logs: batches of length-prefixed JSON documents.

A message's key is a version and the entries' keys, its value the entries' values, each with its length before
it (64-bit, big-endian). Byte strings are base64 in the JSON; empty ones, and an expiry of 0, are left out."""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.operators import folds

# Fixed values of the format: its version and the kinds of entries.
VERSION, KV, RESOLVED = 1, 4, 3
#: Entries that are decoded at once, whatever messages hold.
DECODED = 4096
PROTOCOLS = ("default", "open", "open-protocol", "canal", "avro", "maxwell", "canal-json", "craft")


def check_params(max_message_bytes: str | int = folds.MESSAGE_BYTES, max_batch_size: str | int = folds.MESSAGE_ENTRIES) -> tuple[int, int]:
    """Both limits as positive 32-bit numbers, or ValueError."""
    out = []
    for name, v in (("max-message-bytes", max_message_bytes), ("max-batch-size", max_batch_size)):
        n = int(v)
        if not 0 < n <= 2**31 - 1:
            raise ValueError(f"{name} must be positive and below 2**31, not {v}")
        out.append(n)
    return out[0], out[1]


def codec_of(protocol: str) -> str:
    """The format that a protocol's name stands for: all known names use the open one."""
    if protocol.lower() not in PROTOCOLS:
        raise ValueError(f"unknown protocol {protocol!r}")
    return "open"


def _some(value: Column) -> Column:
    return F.when(F.length(value) > 0, value)


def entry_key(ts: str = "crts", key: str = "key") -> Column:
    return F.to_json(F.struct(F.col(ts).alias("ts"), _some(F.col(key)).alias("k"), F.lit(KV).alias("t"))).cast("binary")


def entry_value(op: str = "op_type", value: str = "value", expired: str = "expired_ts") -> Column:
    return F.to_json(F.struct(F.col(op).alias("op"), _some(F.col(value)).alias("v"), F.when(F.col(expired) != 0, F.col(expired)).alias("ex"))).cast("binary")


def _prefixed(data: Column) -> Column:
    return F.concat(F.unhex(F.lpad(F.hex(F.length(data).cast("bigint")), 16, "0")), data)


def _joined(parts: Column) -> Column:
    return F.unhex(F.array_join(F.transform(parts, F.hex), ""))


def encode(log: DataFrame, by: str, max_bytes: int = folds.MESSAGE_BYTES, max_entries: int = folds.MESSAGE_ENTRIES) -> DataFrame:
    """Messages of each `by` (such as a queue partition) in event order: by, group (number), key, value, ts (of
    the last entry), entries. A message holds at most max_entries, so gathering its parts is bounded."""
    made = log.select(by, "crts", "sequence", entry_key().alias("k"), entry_value().alias("v")).withColumns({"key_bytes": F.length("k"), "value_bytes": F.length("v")})
    packed = folds.pack_messages(made, by, ["crts", "sequence"], max_bytes, max_entries)
    parts = packed.groupBy(by, "group").agg(F.array_sort(F.collect_list(F.struct("crts", "sequence", "k", "v"))).alias("parts"))
    head = F.unhex(F.lit(f"{VERSION:016x}"))
    key = F.concat(head, _joined(F.transform("parts", lambda p: _prefixed(p["k"]))))
    return parts.select(by, "group", key.alias("key"), _joined(F.transform("parts", lambda p: _prefixed(p["v"]))).alias("value"), F.element_at("parts", -1)["crts"].alias("ts"), F.size("parts").alias("entries"))


def checkpoint_message(ts: Column) -> tuple[Column, Column]:
    """Key and value of the message that all entries up to ts are complete."""
    body = F.to_json(F.struct(ts.alias("ts"), F.lit(RESOLVED).alias("t"))).cast("binary")
    return F.concat(F.unhex(F.lit(f"{VERSION:016x}")), _prefixed(body)), F.unhex(F.lit("00" * 8))


def broadcast_checkpoint(ts: int, messages: DataFrame, partitions: int) -> DataFrame:
    """The checkpoint's message for every partition of the queue."""
    key, value = checkpoint_message(F.lit(ts).cast("bigint"))
    return messages.sparkSession.range(partitions).select(F.col("id").cast("int").alias("partition"), key.alias("key"), value.alias("value"), F.lit(ts).cast("bigint").alias("ts"))


def frames(data: bytes) -> Iterator[bytes]:
    """The length-prefixed parts of a buffer."""
    at = 0
    while at < len(data):
        (n,) = struct.unpack_from(">Q", data, at)
        if at + 8 + n > len(data):
            raise ValueError("a part reaches beyond its buffer")
        yield data[at + 8 : at + 8 + n]
        at += 8 + n


def decode_message(key: bytes, value: bytes) -> Iterator[tuple]:
    """(op_type, key, value, crts, expired_ts) of each entry; markers have op 3 and neither key nor value."""
    (version,) = struct.unpack_from(">Q", key)
    if version != VERSION:
        raise ValueError(f"messages of version {version} are not known")
    for k, v in zip(frames(key[8:]), frames(value), strict=True):
        k = json.loads(k)
        if k["t"] == RESOLVED:
            yield 3, None, None, k["ts"], 0
            continue
        v = json.loads(v)
        yield v["op"], base64.b64decode(k.get("k", "")), base64.b64decode(v.get("v", "")), k["ts"], v.get("ex", 0)


def decode(messages: DataFrame, *keep: str) -> DataFrame:
    """The entries of messages (key, value), with the columns to keep and pos, an entry's place in its message."""
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in messages.select(*keep).schema)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for r in batch.itertuples(index=False, name=None):
                for i, entry in enumerate(decode_message(bytes(r[-2]), bytes(r[-1]))):
                    yield (*r[:-2], *entry, i)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*keep, "op_type", "key", "value", "crts", "expired_ts", "pos"]
        made = entries(batches)
        while rows := list(islice(made, DECODED)):
            yield pd.DataFrame(rows, columns=names)

    return messages.select(*keep, "key", "value").mapInPandas(run, f"{kept}op_type int, key binary, value binary, crts bigint, expired_ts bigint, pos int")


def mixed(key: bytes, value: bytes) -> bytes:
    """One buffer with the version, then each entry's key and value in turn."""
    pairs = zip(frames(key[8:]), frames(value), strict=True)
    return key[:8] + b"".join(struct.pack(">Q", len(p)) + p for pair in pairs for p in pair)


def decode_mixed(data: bytes) -> Iterator[tuple]:
    parts = list(frames(data[8:]))
    pack = lambda xs: b"".join(struct.pack(">Q", len(x)) + x for x in xs)
    return decode_message(data[:8] + pack(parts[0::2]), pack(parts[1::2]))
