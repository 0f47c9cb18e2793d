"""Restore of a backup by cuts: a row a file, region and rewrite rule, each of which a task reads by itself."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators import ranges
from keyloom.plans import backups

#: Fixed value: what follows a prefix in the end of a cut that nothing else bounds; no key under it is above that.
ABOVE = b"\xff" * 10
_ROWS = "region_id bigint, key binary, value binary"
_SCHEMA = pa.schema([("region_id", pa.int64()), ("key", pa.binary()), ("value", pa.binary())])


def cuts(files: DataFrame, regions: DataFrame, start: bytes = b"", end: bytes | None = None, rules: list[tuple[bytes, bytes]] = ((b"", b""),)) -> DataFrame:
    """(name, region_id, old_prefix, new_prefix, start, end): of every file what goes to each region, in the keys as
    they will be. Keys of a file under a rule's old prefix get its new one; a prefix's cut ends at the prefix and
    ABOVE unless the region, the file or the restored range [start, end) ends before. Empty cuts are left out.

    Rules are a short list and old prefixes do not begin with each other (ValueError otherwise), so that a key has one;
    the regions must cover the restored range (ValueError otherwise: rows would be lost). Regions have region_id, start
    and end; files name, start_key and end_key (exclusive, NULL: open)."""
    spark = files.sparkSession
    olds = sorted(o for o, _ in rules)
    if any(b.startswith(a) for a, b in zip(olds, olds[1:], strict=False)):
        raise ValueError("an old prefix begins with another")
    listed = spark.createDataFrame([(bytearray(o), bytearray(n)) for o, n in rules], "old_prefix binary, new_prefix binary")
    pairs = files.select("name", "start_key", "end_key").join(F.broadcast(listed))  # a row a rule
    above = F.concat(F.col("old_prefix"), F.lit(ABOVE))
    own = pairs.filter(K.overlaps("start_key", "end_key", "old_prefix", above))

    def renamed(key):
        """A key at or above the old prefix in the new keys: one beyond all keys of the prefix is the end of all."""
        cut = F.substring(key, F.length("old_prefix") + 1, F.lit(2**31 - 1))
        return F.when(F.startswith(key, F.col("old_prefix")), F.concat(F.col("new_prefix"), cut)).otherwise(F.concat(F.col("new_prefix"), F.lit(ABOVE)))

    low = renamed(F.greatest("start_key", "old_prefix"))
    high = F.when(F.col("end_key").isNull(), F.concat(F.col("new_prefix"), F.lit(ABOVE))).otherwise(renamed(F.col("end_key")))
    spans = own.select("name", "old_prefix", "new_prefix", low.alias("start"), high.alias("end"))
    whole, low, high = regions.select("region_id", "start", "end"), F.lit(start), F.lit(end).cast("binary")
    if not ranges.gaps(whole, start, end).isEmpty():
        raise ValueError("the regions do not cover the range to restore")
    met = ranges.intersect(spans, whole.filter(K.overlaps("start", "end", low, high)))
    made = met.withColumns({"start": F.greatest("start", low), "end": F.least("end", high)}).filter(F.col("start") < F.col("end"))
    return made.select("name", "region_id", "old_prefix", "new_prefix", "start", "end")


def needed_groups(meta: pq.FileMetaData, low: bytes, high: bytes | None) -> list[int]:
    """Row groups of a file that may hold keys of [low, high), by their statistics."""
    at, out = meta.schema.to_arrow_schema().get_field_index("key"), []
    for g in range(meta.num_row_groups):
        s = meta.row_group(g).column(at).statistics
        if s is None or not s.has_min_max or (s.max >= low and (high is None or s.min < high)):
            out.append(g)
    return out


def _reader(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(uri)
        for b in batches:
            for cut in b.to_pylist():
                old, new, low, high = (cut[c] for c in ("old_prefix", "new_prefix", "start", "end"))
                back = lambda k: old + k[len(new) :] if k.startswith(new) else k  # noqa: B023, E731
                frm, to = back(low), back(high) if high.startswith(new) else None
                with store.open_input_file(f"{path}/data/{cut['name']}") as f:
                    file = pq.ParquetFile(f)
                    for g in needed_groups(file.metadata, frm, to):
                        t = file.read_row_group(g, columns=["key", "value"])
                        key = t.column("key").cast(pa.binary())
                        keep = pc.and_(pc.starts_with(key, old), pc.greater_equal(key, pa.scalar(frm, pa.binary())))
                        keep = keep if to is None else pc.and_(keep, pc.less(key, pa.scalar(to, pa.binary())))
                        t = t.set_column(0, "key", key).filter(keep)
                        if t.num_rows:
                            keys = t.column("key").to_pylist() if old != new else t.column("key")
                            keys = pa.array([new + k[len(old) :] for k in keys], pa.binary()) if old != new else keys
                            out = pa.table({"region_id": pa.array([cut["region_id"]] * t.num_rows, pa.int64()), "key": keys, "value": t.column("value").cast(pa.binary())}, _SCHEMA)
                            yield from out.combine_chunks().to_batches()

    return run


def restored(spark: SparkSession, path: str, plan: DataFrame, tasks: int | None = None) -> DataFrame:
    """(region_id, key, value) of a backup by the cuts of a plan. A task opens a cut's file, reads the row groups that
    its statistics leave, and puts rows out a group at a time; files and groups that no cut needs are not read. The
    backup is where pyarrow finds it by URI, as executors do."""
    dealt = plan.repartition(tasks, "name", "region_id") if tasks else plan.repartition("name", "region_id")
    return dealt.mapInArrow(_reader(path if "://" in path else f"file://{path}"), _ROWS)


def restore_regions(spark: SparkSession, path: str, regions: DataFrame, start: bytes = b"", end: bytes | None = None, rules: list[tuple[bytes, bytes]] = ((b"", b""),)) -> DataFrame:
    """The rows of a backup for each region, in the keys as rules make them; [start, end) is in those keys."""
    return restored(spark, path, cuts(spark.read.parquet(f"{path}/files"), regions, start, end, rules))


def checked(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """One row: whether a restore of the whole backup has the checksum that its metadata add up to."""
    from keyloom.operators import checksums

    return checksums.equal(checksums.checksum(restore_regions(spark, path, regions)), backups.metadata_checksum(spark.read.parquet(f"{path}/files")))
