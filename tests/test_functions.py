import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keyloom.functions import codec, hashes, timestamps
from keyloom.functions import keys as K


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_written_keys():
    assert K.parse_key("raw", "abcde") == b"abcde"
    assert K.parse_key("hex", "78bcacef") == bytes.fromhex("78bcacef")
    assert K.parse_key("escaped", "\\a\\x1") == bytes([7, 1])
    assert K.parse_key("escaped", "\\b\\f") == bytes([8, 12])
    assert K.parse_key("escaped", "a\\x00\\101") == b"a\x00A"
    for form, text in (("hex", "abcde"), ("other", "a"), ("escaped", "a\\")):
        with pytest.raises(ValueError):
            K.parse_key(form, text)


def test_written_spans():
    low, high = K.V2_PREFIX, K.V2_END
    assert K.parse_span("raw", "", "") == (low, high)
    assert K.parse_span("raw", "", "z") == (low, low + b"z")
    assert K.parse_span("raw", "a", "") == (low + b"a", high)
    assert K.parse_span("raw", "a", "z") == (low + b"a", low + b"z")
    with pytest.raises(ValueError):
        K.parse_span("raw", "z", "y")


def test_v2_keys_and_ranges(spark):
    df = spark.createDataFrame([(bytearray(b"a"), None), (bytearray(b""), bytearray(b"c"))], "s binary, e binary")
    got = df.select(*[F.hex(c) for c in K.encode_v2_range("s", "e")]).collect()
    assert [tuple(r) for r in got] == [("7200000061", "72000001"), ("72000000", "7200000063")]
    there = df.select(*[c.alias(n) for n, c in zip("se", K.encode_v2_range("s", "e"), strict=True)])
    back = there.select(*K.convert_range("s", "e", "v2", "v1")).collect()
    assert [tuple(r) for r in back] == [(b"a", None), (b"", b"c")]
    with pytest.raises(Exception, match="without the V2 prefix"):
        df.select(K.decode_v2("s")).collect()
    assert df.select(K.decode_v2("s", "null").alias("k")).collect()[0].k is None


def test_ends(spark):
    rows = [(b"", None), (b"\xff" * 5, None), (b"a", b"a")]
    df = spark.createDataFrame([(bytearray(a), b and bytearray(b)) for a, b in rows], "e binary, want binary")
    assert all(r.got == r.want for r in df.select("want", K.normal_end("e").alias("got")).collect())
    pairs = spark.createDataFrame([(None, None, 0), (None, bytearray(b"a"), 1), (bytearray(b"a"), None, -1), (bytearray(b"\x7f"), bytearray(b"\x80"), -1)], "a binary, b binary, want int")
    assert all(r.got == r.want for r in pairs.select("want", K.compare_ends("a", "b").alias("got")).collect())


def test_memcomparable_keeps_order(spark):
    keys = [b"", b"\x00", b"a", b"a\x00", b"abcdefgh", b"abcdefgh\x00", b"abcdefghi", b"\xff" * 9]
    df = spark.createDataFrame([(bytearray(k),) for k in keys], "k binary").withColumn("c", K.encode_memcomparable("k")).withColumn("back", K.decode_memcomparable("c"))
    got = {bytes(r.k): r for r in df.collect()}
    assert bytes(got[b"a"].c) == b"a" + b"\x00" * 7 + bytes([248])
    assert bytes(got[b"abcdefgh"].c) == b"abcdefgh\xff" + b"\x00" * 8 + bytes([247])
    assert all(bytes(r.back) == k for k, r in got.items())
    assert sorted(keys) == sorted(keys, key=lambda k: bytes(got[k].c))


def test_hashes(spark):
    raw = pd.Series([b"", b"123456789", b"hello", None, b"abcd", b"x" * 37])
    crc = [int(x) for x in hashes.crc64_values(raw)]
    assert crc[1] == 0x995DC9BBDF1939FA and crc[0] == 0 == crc[3]
    assert [int(x) for x in hashes.murmur3_values(raw)][:3] == [0, 0xB4FEF382, 0x248BFA47]
    assert int(hashes.murmur3_64_values(pd.Series([b"hello"]))[0]) == 0xCBD8A7B341BD9B02
    df = spark.createDataFrame([(bytearray(b"123456789"),), (None,)], "k binary").select(hashes.crc64("k").alias("c"), hashes.dispatch("k", 7).alias("b"))
    assert [r.c for r in df.collect()] == [0x995DC9BBDF1939FA - (1 << 64), None]
    assert zlib.crc32(b"a") == one(spark, F.crc32(F.lit(b"a")).alias("x")).x


def test_timestamps(spark):
    r = one(spark, timestamps.as_timestamp(F.lit(424316552636792833)).cast("string").alias("t"), timestamps.logical(F.lit(424316552636792833)).alias("l"), timestamps.moved_back(timestamps.compose(F.lit(5000), F.lit(7)), 3000).alias("b"))
    assert (r.t, r.l, r.b) == ("2021-04-17 05:59:53.103", 1, (2000 << 18) + 7)
    with pytest.raises(ValueError):
        timestamps.ago(5, 6)


def test_messages(spark):
    rows = [(1, bytearray(b"key"), bytearray(b"value"), 100, 200, 1, "p"), (2, bytearray(b"\xff"), None, 101, 0, 2, "p"), (1, bytearray(b""), bytearray(b"v"), 102, 0, 3, "q")]
    log = spark.createDataFrame(rows, "op_type int, key binary, value binary, crts bigint, expired_ts bigint, sequence bigint, part string")
    sizes = log.select(F.length(codec.entry_key()).alias("k"), F.length(codec.entry_value()).alias("v")).first()
    assert sizes.k + sizes.v + 16 == 75
    messages = codec.encode(log, "part")
    got = codec.decode(messages, "part").orderBy("crts").collect()
    assert [(r.op_type, bytes(r.key), bytes(r.value), r.crts, r.expired_ts) for r in got] == [(1, b"key", b"value", 100, 200), (2, b"\xff", b"", 101, 0), (1, b"", b"v", 102, 0)]
    m = messages.filter("part = 'p'").first()
    assert list(codec.decode_mixed(codec.mixed(bytes(m.key), bytes(m.value)))) == list(codec.decode_message(bytes(m.key), bytes(m.value)))
    assert codec.check_params("8192", 64) == (8192, 64) and codec.codec_of("Canal") == "open"
    with pytest.raises(ValueError):
        codec.check_params(0)
    with pytest.raises(ValueError):
        list(codec.frames(b"\0" * 7 + b"\x09ab"))
    with pytest.raises(Exception, match="does not fit"):
        codec.encode(log, "part", 60).collect()
