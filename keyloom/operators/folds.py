"""Folds whose running sum starts anew: merging small ranges, packing messages. They are no window functions,
as where one group ends depends on where the last one did."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Limits of a merged range: bytes and keys.
MERGE_BYTES, MERGE_KEYS = 96 << 20, 960_000
#: Limits of a message: bytes and entries; and the bytes that every message and every entry adds.
MESSAGE_BYTES, MESSAGE_ENTRIES = 8192, 64
MESSAGE_OVERHEAD, ENTRY_OVERHEAD, VERSION_BYTES = 36, 16, 8


def _run(ordered: DataFrame, by: str, order: list[str], step, schema: str) -> DataFrame:
    """Number the rows of each `by` with a fold over them in order; state is carried from batch to batch, so
    that no group is held in memory."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = object(), None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if getattr(row, by) != at:
                    at, state = getattr(row, by), None
                state, made = step(state, row)
                out.append(made)
            yield frame.assign(group=pd.Series(out, dtype="int64", index=frame.index))

    dealt = ordered.repartition(by).sortWithinPartitions(by, *order)
    return dealt.mapInPandas(fold, schema)


def merge_ranges(files: DataFrame, by: str, order: str, max_bytes: int = MERGE_BYTES, max_keys: int = MERGE_KEYS) -> DataFrame:
    """Number the merged range (column group, from 0) of each file, taken in order within `by`: a file joins the
    range before it if it has no bytes, or if both sums stay within their limits. Columns total_bytes, total_kvs."""

    def step(state, row):
        if state is not None and (row.total_bytes == 0 or state[1] + row.total_bytes <= max_bytes and state[2] + row.total_kvs <= max_keys):
            state = (state[0], state[1] + row.total_bytes, state[2] + row.total_kvs)
        else:
            state = (0 if state is None else state[0] + 1, row.total_bytes, row.total_kvs)
        return state, state[0]

    return _run(files, by, [order], step, _with_group(files))


def pack_messages(entries: DataFrame, by: str, order: list[str], max_bytes: int = MESSAGE_BYTES, max_entries: int = MESSAGE_ENTRIES) -> DataFrame:
    """Number the message (column group, from 0) of each entry within `by`, from the sizes of its encoded key and
    value (key_bytes, value_bytes). A message ends when it has its entries or the next would make it too large;
    an entry too large for any message raises an error."""

    def step(state, row):
        size = row.key_bytes + row.value_bytes + ENTRY_OVERHEAD
        alone = size + MESSAGE_OVERHEAD + VERSION_BYTES
        if alone > max_bytes:
            raise ValueError(f"an entry of {alone} bytes does not fit into messages of {max_bytes}")
        if state is None or state[2] >= max_entries or state[1] + size > max_bytes:
            state = (0 if state is None else state[0] + 1, alone, 1)
        else:
            state = (state[0], state[1] + size, state[2] + 1)
        return state, state[0]

    return _run(entries, by, order, step, _with_group(entries))


def _with_group(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", group bigint"


def merge_statistics(files: DataFrame, merged: DataFrame) -> DataFrame:
    """Ranges, bytes and keys before and after; averages are whole numbers. Regions before are the larger of the
    numbers of default and write files; without any file of these the call is an error."""
    kinds = files.agg(F.count_if(F.col("cf") == "default").alias("d"), F.count_if(F.col("cf") == "write").alias("w"), F.sum("total_bytes").alias("bytes"), F.sum("total_kvs").alias("kvs"))
    n = F.when(F.greatest("d", "w") > 0, F.greatest("d", "w")).otherwise(F.raise_error(F.lit("no default or write files")).cast("bigint"))
    after = merged.agg(F.count("*").alias("merged_regions"))
    whole = kinds.withColumn("total_regions", n).crossJoin(after)  # a row each
    return whole.select("total_regions", "merged_regions", F.expr("bytes div total_regions").alias("region_bytes"), F.expr("kvs div total_regions").alias("region_kvs"), F.expr("bytes div merged_regions").alias("merged_bytes"), F.expr("kvs div merged_regions").alias("merged_kvs"))
