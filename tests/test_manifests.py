"""Counter mode against published values, and sealed manifests."""

import pytest
from keyloom.functions.ctr import ctr
from keyloom.plans import manifests
from pyspark.sql import functions as F

# The published examples of AES in counter mode with keys of 128, 192 and 256 bits.
IV = "f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff"
PLAIN = "6bc1bee22e409f96e93d7e117393172aae2d8a571e03ac9c9eb76fac45af8e5130c81c46a35ce411e5fbc1191a0a52eff69f2445df4f9b17ad2b417be66c3710"
VECTORS = [
    ("2b7e151628aed2a6abf7158809cf4f3c", "874d6191b620e3261bef6864990db6ce9806f66b7970fdff8617187bb9fffdff5ae4df3edbd5d35e5b4f09020db03eab1e031dda2fbe03d1792170a0f3009cee"),
    ("8e73b0f7da0e6452c810f32b809079e562f8ead2522c6b7b", "1abc932417521ca24f2b0459fe7e6e0b090339ec0aa6faefd5ccc2c6f4ce8e941e36b26bd1ebc670d1bd1d665620abf74f78a7f6d29809585a97daec58c6b050"),
    ("603deb1015ca71be2b73aef0857d77811f352c073b6108d72d9810a30914dff4", "601ec313775789a5b7a7f504bbf3d228f443e3ca4d62b59aca84e990cacaf5c52b0930daa23de94ce87017ba2d84988ddfc9c58db67aada613c2dd08457941a6"),
]
SCHEMA = "name string, cf string, size bigint"


@pytest.mark.parametrize("key,sealed", VECTORS)
def test_published_values(spark, key, sealed):
    key, iv, plain, sealed = (bytes.fromhex(x) for x in (key, IV, PLAIN, sealed))
    rows = [(0, bytearray(plain)), (0, None), (0, bytearray(b""))]
    df = spark.createDataFrame(rows, "at bigint, v binary")
    got = [r[0] and bytes(r[0]) for r in df.select(ctr(F.col("v"), F.lit(key), F.lit(iv))).collect()]
    assert sorted(x for x in got if x) == [sealed] and None in got
    # any range by itself, across blocks too
    parts = [(a, bytearray(sealed[a:b])) for a, b in ((0, 5), (3, 16), (16, 48), (15, 17), (33, 64))]
    made = spark.createDataFrame(parts, "at bigint, v binary").select("at", F.length("v").alias("n"), ctr(F.col("v"), F.lit(key), F.lit(iv), F.col("at")).alias("p")).collect()
    assert all(bytes(r.p) == plain[r["at"] : r["at"] + r.n] for r in made)


def test_counters_wrap_around(spark):
    key, iv = bytes(range(16)), b"\xff" * 16
    df = spark.range(1).select(ctr(F.lit(bytes(48)), F.lit(key), F.lit(iv)).alias("a"), ctr(F.lit(bytes(32)), F.lit(key), F.lit(bytes(16))).alias("b"))
    r = df.first()
    assert bytes(r.a)[16:] == bytes(r.b)  # after the largest counter comes zero
    with pytest.raises(Exception, match="16 bytes"):
        spark.range(1).select(ctr(F.lit(b"x"), F.lit(key), F.lit(b"short"))).collect()


@pytest.mark.parametrize("key", [None, bytes(range(32))])
def test_manifests(spark, tmp_path, key):
    rows = [(f"f{i:04d} ä\n", None if i % 3 else "default", i) for i in range(500)]
    files, path = spark.createDataFrame(rows, SCHEMA).repartition(3), f"file://{tmp_path}/m"
    manifests.write_manifest(files, path, key, limit=2000)
    docs = spark.read.parquet(path)
    assert docs.count() > 10 and docs.agg(F.sum("files")).first()[0] == 500
    assert sorted(map(tuple, manifests.read_manifest(spark, path, SCHEMA, key).collect())) == rows
    if key is None:
        return
    for r in manifests.read_bytes(spark, path, 8, 30, key).collect():
        assert bytes(r.raw)[:6] == b'"' + r["first"][:5].encode() and len(r.raw) == 30  # after {"name":
    for wrong in (bytes(32), None):
        with pytest.raises(Exception, match="damaged|encrypted"):
            manifests.read_manifest(spark, path, SCHEMA, wrong).collect()
