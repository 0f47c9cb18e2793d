"""A change feed as a streaming source: entries of key ranges in commit order, from a timestamp on, and then what is
added, with an offset a range.

A feed is a folder of appends (append=00000000, ...), each with a folder a range (region_id=...) of Parquet files that
are sorted by commit timestamp; an append counts once Spark has marked it as complete. Within a range an append's
timestamps are above those of the appends before it."""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a row group: what a batch takes whole.
GROUP_BYTES = 1 << 20
#: Ranges that have no more than this in a batch together are read by one task, and row groups at once.
TASK_BYTES = 128 << 10
#: Rows of a row group have numbers below this, so that a row's sequence is its group's place and its own.
GROUP_ROWS = 1 << 24
FEED = "region_id bigint, kind string, key binary, start_ts bigint, crts bigint, op_type int, value binary, old_value binary, sequence bigint"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
_SCHEMA = pa.schema([(n, _KINDS[t]) for n, t in (c.split() for c in FEED.split(", "))])
_STORED = [f.name for f in _SCHEMA if f.name not in ("region_id", "kind", "sequence")]


def append_feed(log: DataFrame, path: str, number: int, group_bytes: int = GROUP_BYTES) -> None:
    """Add entries (region_id, key, start_ts, crts, op_type, value, old_value) as append `number`: each range's files
    follow each other by commit timestamp. A range of any size is spread over several files. Version 2 of Parquet's pages
    stores timestamps that rise, and values alike, as differences."""
    rows = log.select("region_id", *_STORED).repartitionByRange("region_id", "crts").sortWithinPartitions("region_id", "crts")
    written = rows.write.option("parquet.block.size", group_bytes).option("parquet.writer.version", "v2")
    written.partitionBy("region_id").mode("errorifexists").parquet(f"{path}/append={number:08d}")


#: Footers of the files that this process has read last, so many at most; files do not change. A footer grows with its
#: file, so it is not read anew for each row group.
FOOTERS = 16
_FOOTERS: OrderedDict[str, pq.FileMetaData] = OrderedDict()


def _opened(f, file: str) -> pq.ParquetFile:
    out = pq.ParquetFile(f, metadata=_FOOTERS.pop(file, None))
    _FOOTERS[file] = out.metadata
    if len(_FOOTERS) > FOOTERS:
        _FOOTERS.popitem(last=False)
    return out


def _rows(file: pq.ParquetFile, groups: Iterable[tuple[str, int, int]]) -> Iterator[pa.Table]:
    """Rows of a file's row groups with their sequences; small groups are read together."""

    def read():
        places = [np.arange(place * GROUP_ROWS, place * GROUP_ROWS + n) for _, place, n in held]
        return file.read_row_groups([g for g, _, _ in held], columns=_STORED).append_column("sequence", pa.array(np.concatenate(places)))

    held, size = [], 0
    for _, group, place in groups:
        facts = file.metadata.row_group(group)
        if held and size + facts.total_byte_size > TASK_BYTES:
            yield read()
            held, size = [], 0
        held.append((group, place, facts.num_rows))
        size += facts.total_byte_size
    yield read()


@dataclass
class FeedRange:
    """The row groups of a range that a batch reads: (file, group, place in the range)."""

    region: int
    groups: list[tuple[str, int, int]]
    start_ts: int
    initialized: int | None


class FeedPartition(InputPartition):
    """Ranges that a task reads one after the other."""

    def __init__(self, ranges: list[FeedRange]):
        self.ranges = ranges


class FeedReader(DataSourceStreamReader):
    """Offsets are places in each range's row groups (at), and how many were there at first (scan)."""

    def __init__(self, options):
        self.fs, self.path = fs.FileSystem.from_uri(options["path"])
        self.start_ts, self.quota = int(options.get("start_ts", -1)), int(options.get("max_bytes", 0))
        self.progress = options.get("progress")
        self.seen: set[str] = set()
        self.groups: dict[str, list[tuple[str, int, int, int, int]]] = {}  # region: file, group, bytes, lowest and highest crts
        self.now: dict | None = None

    def _find(self) -> None:
        """Learn the row groups of appends that have become complete; files of known ones are not looked at again."""
        tops = sorted(i.path for i in self.fs.get_file_info(fs.FileSelector(self.path, allow_not_found=True)) if i.type == fs.FileType.Directory and "/append=" in i.path)
        for top in tops:
            if top in self.seen:
                continue
            if self.fs.get_file_info(f"{top}/_SUCCESS").type == fs.FileType.NotFound:
                break  # the ones after it wait, so that places stay as they are
            for file in sorted(i.path for i in self.fs.get_file_info(fs.FileSelector(top, recursive=True)) if i.path.endswith(".parquet")):
                region = re.search(r"/region_id=(-?\d+)/", file)[1]
                with self.fs.open_input_file(file) as f:
                    meta = pq.ParquetFile(f).metadata
                at = meta.schema.to_arrow_schema().get_field_index("crts")
                for g in range(meta.num_row_groups):
                    facts = meta.row_group(g)
                    stats = facts.column(at).statistics
                    self.groups.setdefault(region, []).append((file, g, facts.total_byte_size, stats.min, stats.max))
            self.seen.add(top)

    def initialOffset(self) -> dict:
        self._find()
        return {"scan": {r: len(g) for r, g in self.groups.items()}, "at": {}}

    def _planned(self) -> dict | None:
        """The last offset that the query has planned, from its checkpoint: where a restarted one goes on."""
        if not self.progress:
            return None
        where, path = fs.FileSystem.from_uri(self.progress)
        names = [i.path for i in where.get_file_info(fs.FileSelector(f"{path}/offsets", allow_not_found=True)) if i.base_name.isdigit()]
        if not names:
            return None
        with where.open_input_file(max(names, key=lambda n: int(n.rsplit("/", 1)[1]))) as f:
            return json.loads(f.read().decode().splitlines()[-1])

    def latestOffset(self) -> dict:
        self._find()
        if self.now is None:
            self.now = self._planned()
        if self.now is None:  # a new query, or one that has not said where its checkpoint is
            self.now, limit = self.initialOffset(), self.quota if self.progress else 0
        else:
            limit = self.quota
        self.now = {"scan": self.now["scan"], "at": self._admitted(self.now["at"], limit)}
        return self.now

    def _admitted(self, at: dict, limit: int) -> dict:
        """Places after a batch of at most `limit` bytes, oldest entries first. Row groups that share a commit timestamp
        go together, so that no timestamp is ever split; if one alone is larger than the limit, the batch is that one."""
        if not limit:
            return {r: len(g) for r, g in self.groups.items()}
        out, taken = {r: max(0, at.get(r, 0)) for r in self.groups}, 0
        heap = [(g[out[r]][3], r) for r, g in self.groups.items() if out[r] < len(g)]
        heapq.heapify(heap)
        while heap:
            _, r = heapq.heappop(heap)
            groups, to = self.groups[r], out[r] + 1
            while to < len(groups) and groups[to][3] == groups[to - 1][4]:
                to += 1
            size = sum(g[2] for g in groups[out[r] : to])
            if taken and taken + size > limit:
                break
            out[r], taken = to, taken + size
            if to < len(groups):
                heapq.heappush(heap, (groups[to][3], r))
        return out

    def partitions(self, start: dict, end: dict) -> list[FeedPartition]:
        self._find()
        self.now = self.now or end
        made, room = [], 0
        for region, to in end["at"].items():
            frm, scan = start["at"].get(region, -1), end["scan"].get(region, 0)
            groups = self.groups[region]
            here = [(groups[k][0], groups[k][1], k) for k in range(max(0, frm), to) if groups[k][4] > self.start_ts]
            for k in range(max(1, frm), to):
                if groups[k][3] < groups[k - 1][4]:
                    raise ValueError(f"range {region}: {groups[k][0]} goes back behind timestamp {groups[k - 1][4]}")
            first = frm < scan <= to or (frm < 0 and not scan)
            if here or first:
                size = sum(groups[k][2] for _, _, k in here)
                if not made or size > room:
                    made.append(FeedPartition([]))
                    room = TASK_BYTES
                room -= size
                made[-1].ranges.append(FeedRange(int(region), here, self.start_ts, max(scan, 0) if first else None))
        return made

    def read(self, partition: FeedPartition) -> Iterator[pa.RecordBatch]:
        """The ranges' rows; what a few row groups have leaves together."""
        held, size = [], 0
        for t in itertools.chain.from_iterable(map(self._read, partition.ranges)):
            held.append(t)
            size += t.nbytes
            if size > TASK_BYTES:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    def _read(self, part: FeedRange) -> Iterator[pa.Table]:
        """The range's entries, with a marker where its history has been read and one for what is complete after it."""
        resolved, last = None, -1
        marker = part.initialized

        def mark(kind, ts, sequence):
            row = {"region_id": part.region, "kind": kind, "crts": ts, "op_type": 3, "sequence": sequence}
            return pa.Table.from_pylist([row], _SCHEMA)

        for (file, new), groups in itertools.groupby(part.groups, lambda g: (g[0], part.initialized is not None and g[2] >= part.initialized)):
            if new and marker is not None:
                yield mark("initialized", None, marker * GROUP_ROWS - 2)
                marker = None
            with self.fs.open_input_file(file) as f:
                opened = _opened(f, file)
                for t in _rows(opened, groups):
                    n = t.num_rows
                    t = t.append_column("region_id", pa.repeat(pa.scalar(part.region, pa.int64()), n)).append_column("kind", pa.repeat("committed", n))
                    t = t.select(_SCHEMA.names).cast(_SCHEMA).filter(pc.greater(t.column("crts"), part.start_ts))
                    if t.num_rows:
                        yield t
                        resolved, last = pc.max(t.column("crts")).as_py(), t.column("sequence")[-1].as_py() // GROUP_ROWS
        if marker is not None:
            yield mark("initialized", None, marker * GROUP_ROWS - 2)
        if resolved is not None:
            yield mark("resolved", resolved, (last + 1) * GROUP_ROWS - 1)


class FeedSource(DataSource):
    """Options: path; start_ts (entries at or below it are left out; -1); max_bytes of a batch (none); progress, the
    query's checkpoint folder, without which the first batch of a restarted query takes all that is there."""

    @classmethod
    def name(cls) -> str:
        return "keyloom_feed"

    def schema(self) -> str:
        return FEED

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)


def stream_feed(spark: SparkSession, path: str, **options) -> DataFrame:
    """The feed at a path as a stream of events (see streaming.regions): committed entries, a row where a range's
    history has been read, and after each batch of a range its resolved timestamp. Sequences rise within a range and
    are the same however often a batch is read."""
    spark.dataSource.register(FeedSource)
    reader = spark.readStream.format("keyloom_feed").option("path", path)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()
