"""A key's rows in order, however many a batch has of them."""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Iterator
from heapq import merge
from itertools import islice
from operator import itemgetter
from tempfile import TemporaryFile
from typing import IO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import IntegralType, StructType

#: Rows that are sorted at once, rows of a run that are read at once, and runs that become one; rows put out at once.
RUN, BLOCK, RUNS = 1 << 15, 1 << 8, 64
OUT = 1 << 12


class RowProcessor(StatefulProcessor):
    """A processor of a key's rows one by one, of which a batch may have any number: it takes named tuples and makes
    tuples, and neither are ever held together. (With transformWithState Spark's worker gathers all that a key puts
    out; with transformWithStateInPandas it does not, but numbers beside nulls become floats, so they go as text.)"""

    def handleInputRows(self, key, frames, timerValues) -> Iterator[pd.DataFrame]:
        number = lambda v: int(v) if isinstance(v, str) else None
        key = tuple(number(k) if c in self.numbers else k for c, k in zip(self.keys, key, strict=True))

        def rows():
            for frame in frames:
                values = [map(number, frame[c]) if c in self.numbers else frame[c] for c in self.columns]
                yield from map(made._make, zip(*values, strict=True))

        made = namedtuple("Event", self.columns)
        out = self.handleRows(key, rows())
        while block := list(islice(out, OUT)):
            yield pd.DataFrame(block, columns=self.out, dtype=object)

    def handleRows(self, key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


def by_key(rows: DataFrame, keys: list[str], processor: RowProcessor, schema: str, time_mode: str = "none") -> DataFrame:
    """What the processor makes of each key's rows of a stream, by the schema."""
    processor.keys, processor.columns, processor.out = keys, rows.columns, StructType.fromDDL(schema).names
    processor.numbers = {f.name for f in rows.schema if isinstance(f.dataType, IntegralType)}
    sent = rows.select(*[F.col(c).cast("string").alias(c) if c in processor.numbers else c for c in rows.columns])
    return sent.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", time_mode)


def _written(rows: Iterator[tuple]) -> IO[bytes]:
    file = TemporaryFile()
    while block := list(islice(rows, BLOCK)):
        pickle.dump(block, file, pickle.HIGHEST_PROTOCOL)
    file.seek(0)
    return file


def _read(file: IO[bytes]) -> Iterator[tuple]:
    with file:
        while True:
            try:
                yield from pickle.load(file)
            except EOFError:
                return


def in_order(rows: Iterator[tuple], *by: str) -> Iterator[tuple]:
    """Named tuples in the order of these fields, equal ones as they came. Beyond RUN of them sorted runs go to temporary
    files, so that what is held grows with the logarithm of their number. All rows are read before the first comes out."""
    first = next(rows, None)
    if first is None:
        return iter(())
    made, key = type(first)._make, itemgetter(*[first._fields.index(c) for c in by])
    chunk, levels = [tuple(first)], []  # levels: the files, those of the most rows and the earliest last
    while True:
        chunk += map(tuple, islice(rows, RUN - len(chunk)))
        chunk.sort(key=key)
        if len(chunk) < RUN:
            runs = [_read(f) for level in reversed(levels) for f in level]
            return map(made, merge(*runs, chunk, key=key))
        run, chunk = _written(iter(chunk)), []
        for level in levels:
            level.append(run)
            if len(level) < RUNS:
                break
            run = _written(merge(*map(_read, level), key=key))
            level.clear()
        else:
            levels.append([run])
