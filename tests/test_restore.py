"""Restore by cuts of files and regions."""

import pyarrow.parquet as pq
import pytest
from keyloom.plans import backups, restore
from pyspark.sql import functions as F


def key(n):
    return f"u{n:08d}".encode()


@pytest.fixture(scope="module")
def backup(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('backup')}/b"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pairs = spark.range(2000).select(F.encode(F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 8, "0")), "UTF-8").alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value"))
    backups.backup(pairs, path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def regions(spark, cuts, first=b"", last=None):
    edges = [first, *cuts, last]
    return spark.createDataFrame([(i, bytearray(s), None if e is None else bytearray(e)) for i, (s, e) in enumerate(zip(edges, edges[1:], strict=False))], "region_id bigint, start binary, end binary")


def shown(df):
    return sorted((bytes(r.key), r.region_id, bytes(r.value)) for r in df.collect())


def test_every_row_goes_to_its_region(spark, backup):
    layout = regions(spark, [key(100), key(700), key(701), key(1999)])
    got = shown(restore.restore_regions(spark, backup, layout))
    where = lambda n: sum(n >= c for c in (100, 700, 701, 1999))
    assert got == [(key(n), where(n), str(n).encode()) for n in range(2000)]
    assert restore.checked(spark, backup, layout).first()[0] is True


def test_rewritten_prefixes_and_bounds(spark, backup):
    rules = [(b"u0000000", b"w-"), (b"u0000001", b"a"), (b"u00000150", b"")]
    with pytest.raises(ValueError, match="begins"):
        restore.cuts(spark.read.parquet(f"{backup}/files"), regions(spark, []), rules=[(b"u", b"x"), (b"u0", b"y")])
    got = shown(restore.restore_regions(spark, backup, regions(spark, [b"a5", b"b", b"w-3"]), b"5", None, rules[:2]))
    want = []
    for n in range(2000):
        k = key(n)
        new = next((r + k[len(o) :] for o, r in rules[:2] if k.startswith(o)), None)
        if new is not None and new >= b"5":
            want.append((new, sum(new >= c for c in (b"a5", b"b", b"w-3")), str(n).encode()))
    assert got == sorted(want)


def test_gaps_are_refused_and_only_needed_files_are_read(spark, backup, tmp_path):
    holes = regions(spark, [key(50)]).filter("region_id = 1")
    with pytest.raises(ValueError, match="cover"):
        restore.restore_regions(spark, backup, holes)
    layout = regions(spark, [key(50)])
    plan = restore.cuts(spark.read.parquet(f"{backup}/files"), layout, key(10), key(60))
    names = {r["name"] for r in plan.select("name").distinct().collect()}
    files = spark.read.parquet(f"{backup}/files").collect()
    assert 1 <= len(names) < len(files)
    # a backup without the other files gives the same rows
    spark.read.parquet(f"{backup}/files").write.parquet(f"file://{tmp_path}/c/files")
    (tmp_path / "c/data").mkdir(parents=True)
    for n in names:
        (tmp_path / "c/data" / n).write_bytes(open(f"{backup[7:]}/data/{n}", "rb").read())
    got = shown(restore.restored(spark, f"file://{tmp_path}/c", plan, 2))
    assert got == [(key(n), int(n >= 50), str(n).encode()) for n in range(10, 60)]


def test_row_groups_are_pruned(tmp_path):
    import pyarrow as pa

    pq.write_table(pa.table({"key": [key(n) for n in range(100)], "value": [b""] * 100}), tmp_path / "f", row_group_size=10)
    meta = pq.ParquetFile(tmp_path / "f").metadata
    assert restore.needed_groups(meta, key(25), key(40)) == [2, 3]
    assert restore.needed_groups(meta, key(95), None) == [9] and restore.needed_groups(meta, b"z", None) == []
