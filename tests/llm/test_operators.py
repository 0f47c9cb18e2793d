"""The operators against plain versions: on rows made to be awkward, and on whole small tables."""

import itertools
import tempfile
from pathlib import Path
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyloom.llm import bpe, common, components, decontaminate, induced, line_dedup, media, quality_crf, queries, simhash, sketch, substring_dedup, suffix_dedup, token_counts, token_files

from . import plain

SF = "/root/testdata/sf0.001"
DOCS = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
ITEMS = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet", columns=["item_id", "text"]).to_pylist()]
ONCE = [r for k, r in enumerate(plain.ROWS) if r[0] is not None and r[0] not in [x[0] for x in plain.ROWS[:k]]]


def table(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return df.select("doc_id", *[F.lit(c).alias(c) for c in plain.CLASHES], "text") if clashes else df


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


def test_token_counts(spark):
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    same(rows_of(token_counts.token_counts(table(spark, plain.ROWS)), *columns), plain.token_counts(plain.ROWS))
    same(rows_of(queries.op1_token_counts(spark, SF), *columns), plain.token_counts(DOCS))


def test_decontaminate(spark):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    items = spark.createDataFrame(plain.ITEMS, "item_id string, text string").withColumn("id", F.lit(1))
    same(rows_of(decontaminate.decontaminate(table(spark, plain.ROWS), items), *columns), plain.decontaminated(plain.ROWS, plain.ITEMS))
    same(rows_of(queries.op2_decontaminate(spark, SF), *columns), plain.decontaminated(DOCS, ITEMS))
    clean = decontaminate.decontaminate(table(spark, plain.ROWS), items.limit(0))
    assert clean.filter("contaminated or n_items > 0").count() == 0 and clean.count() == len(plain.ROWS)


def test_substring_dedup(spark):
    def digests(df):
        return rows_of(df.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)), "doc_id", "n_words", "n_removed", "kept_sha256")

    same(digests(substring_dedup.dedup_windows(table(spark, plain.ROWS))), plain.without_windows(plain.ROWS))
    same(digests(substring_dedup.dedup_windows(table(spark, plain.ROWS), window=3, sketch_bits=20)), plain.without_windows(plain.ROWS, 3))
    same(rows_of(queries.op3_substring_dedup(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256"), plain.without_windows(DOCS))


def test_substring_dedup_tells_apart_what_is_not_equal(spark):
    a, b = "a", "b"
    for _ in range(10):  # words on which polynomial hashes modulo a power of two collide
        a, b = a + b, b + a
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*words, a])), (2, " ".join([*words, b])), (3, " ".join(words + words)), (3, "w1 w2"), (4, " ".join(words + words))]
    # whole runs of two words in the same pattern
    rows += [(5, " ".join({"a": "x", "b": "y"}[c] for c in a + b)), (6, " ".join({"a": "x", "b": "y"}[c] for c in b + a))]
    df = substring_dedup.dedup_windows(table(spark, rows)).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    same(rows_of(df, "doc_id", "n_words", "n_removed", "kept_sha256"), plain.without_windows(rows))


def test_substring_dedup_of_runs_with_other_surroundings(spark):
    random = Random(3)
    parts = [" ".join(f"p{k}w{i}" for i in range(random.randrange(4, 30))) for k in range(8)]
    rows = [(i, " ".join(random.choice(parts) if random.random() < 0.6 else f"own{i}x{j}" for j in range(12))) for i in range(60)]
    for window in (5, 10):
        df = substring_dedup.dedup_windows(table(spark, rows), window=window).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
        same(rows_of(df, "doc_id", "n_words", "n_removed", "kept_sha256"), plain.without_windows(rows, window))


def test_suffix_dedup(spark):
    def digests(df):
        return rows_of(df.withColumn("kept_sha256", F.sha2("kept", 256)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

    rows = [(i, t if t is None or len(t) < 20000 else t[:20000]) for i, t in plain.ROWS]
    same(digests(suffix_dedup.dedup_bytes(table(spark, rows))), plain.without_bytes(rows))
    few = [r for r in rows if r[1] is None or len(r[1]) < 5000]
    same(digests(suffix_dedup.dedup_bytes(table(spark, few), length=12, gram=4, sketch_bits=20)), plain.without_bytes(few, 12))
    same(rows_of(queries.op4_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), plain.without_bytes(DOCS))


def test_suffix_dedup_cuts_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rows = [(1, "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(9000))), (2, "x" + "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(400, 3700)))]
    flat = [(b, f, o, p) for b, f, o, p in suffix_dedup._pieces([pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "text": pa.array([r[1].encode() for r in rows])})], 200)]
    starts = [(b.column("id")[0].as_py(), int(p) + k) for b, f, o, p in flat for k in range(len(f) - 199)]
    assert sorted(starts) == [(i, k) for i, t in rows for k in range(len(t) - 199)]


def _suffix_lcp(t):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common_prefix = lambda a, b: next((k for k in itertools.count() if a + k >= len(t) or b + k >= len(t) or t[a + k] != t[b + k]))
    return order, [0] + [common_prefix(a, b) for a, b in itertools.pairwise(order)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=200), st.integers(1, 30), st.sampled_from([64, 1 << 20]))
def test_induced_sorting_matches_plain_suffix_array(values, cap, memory):
    order, lcp = _suffix_lcp(values)
    with tempfile.TemporaryDirectory() as folder:
        parts = list(induced.suffix_buckets(np.array(values, np.uint8), cap, Path(folder), memory))[::-1]
    pos = np.concatenate([np.concatenate([p[0], p[2]]) for p in parts]).tolist()
    got = np.concatenate([np.concatenate([p[1], p[3]]) for p in parts]).tolist()
    assert pos == order
    # a bucket's first suffix shares nothing with the bucket before
    assert [x for k, x in enumerate(got) if k and values[pos[k]] == values[pos[k - 1]]] == [min(x, cap) for k, x in enumerate(lcp) if k and values[pos[k]] == values[pos[k - 1]]]


def test_simhash(spark):
    columns = ("doc_id", "fingerprint", "component_id")
    same(rows_of(simhash.simhash_groups(table(spark, plain.ROWS)), *columns), plain.simhashed(plain.ROWS))
    same(rows_of(queries.op5_simhash(spark, SF), *columns), plain.simhashed(DOCS))


def test_bit_sliced_comparison_finds_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.concatenate([base] + [base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (k, 40)).astype(np.uint64), axis=0) for k in range(1, 9)])
    group = np.sort(rng.integers(0, 3, len(fps)))
    for radius in (0, 1, 4, 6, 7, 20, 31):
        got = {(int(a), int(b)) for i, j in simhash.close_pairs(fps, group, np.zeros(len(fps), np.int64), radius) for a, b in zip(i, j, strict=True)}
        assert got == {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if group[a] == group[b] and int(fps[a] ^ fps[b]).bit_count() <= radius}


def test_masks_meet_all_close_fingerprints():
    rng = np.random.default_rng(2)
    for n in (10, 10**6, 10**9):
        masks = simhash.tables_for(n)
        for _ in range(300):
            far = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(m & far == 0 for m in masks)


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (1, 2), (2, 1)]
    root = {x: x for pair in links for x in pair}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for pair in links for x in pair if pair[0] != pair[1]}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_media(spark, tmp_path):
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")
    media.write_media(table(spark, plain.ROWS), f"file://{tmp_path}/a")
    read = media.read_media(spark, f"file://{tmp_path}/a", range_bytes=700)
    made = media.media_features(read)
    same(rows_of(made, *columns), plain.media(plain.ROWS))
    for r in read.select("media", "payload").collect():
        assert media.from_png(bytes(r.media)) == bytes(r.payload)
    for r in made.groupBy("payload_sha256").agg(F.count_distinct("media_sha256").alias("m"), F.count_distinct("feature").alias("f")).collect():
        assert (r.m, r.f) == (1, 1)
    same(rows_of(queries.op6_media(spark, SF), *columns), plain.media(DOCS))
    media.write_media(table(spark, plain.ROWS).limit(0), f"file://{tmp_path}/b")
    assert media.read_media(spark, f"file://{tmp_path}/b").count() == 0


def test_media_member_is_read_again(tmp_path):
    import io
    import zipfile
    import zlib

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"first")
        z.writestr("b", b"second")
    offset, opened = z.infolist()[1].header_offset, []

    class Torn(io.BytesIO):
        def read(self, n=-1):
            return super().read(n)[: n - 1] if len(opened) < 3 else super().read(n)

    def file(anew):
        if anew or not opened:
            opened.append(Torn(out.getvalue()))
        return opened[-1]

    assert media.read_member(file, offset, 6, zlib.crc32(b"second")) == b"second" and len(opened) == 3
    with pytest.raises(OSError):
        media.read_member(file, offset, 6, 1)


def test_line_dedup(spark):
    def lines(df):
        return rows_of(df.withColumn("removed", F.array_join("removed", ",")), "doc_id", "n_lines", "n_exact", "n_near", "removed")

    same(lines(line_dedup.dedup_lines(table(spark, ONCE))), plain.repeated_lines(ONCE))
    assert line_dedup.dedup_lines(table(spark, plain.ROWS)).count() == len(plain.ROWS)
    docs = [(i, t) for i, t in DOCS if len(t or "") < 3000]
    same(lines(line_dedup.dedup_lines(table(spark, docs))), plain.repeated_lines(docs))
    kept = line_dedup.without_repeated_lines(table(spark, ONCE))
    assert kept.columns == table(spark, ONCE).columns
    gone = {i: {int(p) for p in x.split(",") if p} for i, *_, x in plain.repeated_lines(ONCE)}
    want = [(i, t if not gone[i] else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])) for i, t in ONCE]
    same(rows_of(kept, "doc_id", "text"), want)


def test_line_dedup_is_native(spark):
    plan = line_dedup.dedup_lines(table(spark, ONCE))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("edits", [((10, 1), (20, 2)), ((5, 1), (12, 2), (24, 3)), ((20, 2),)])
def test_near_lines_of_every_kind_are_met(spark, edits):
    rng = np.random.default_rng(4)
    letters = "abcde"
    base = ["".join(rng.choice(list(letters), n)) for n in (9, 10, 11, 18, 20, 21, 22, 25, 31, 40) for _ in range(2)]
    made = []
    for k, line in enumerate(base):
        made.append((1000 + k, line))
        for e in range(12):
            x = list(line)
            for _ in range(int(rng.integers(1, 4))):
                p = int(rng.integers(0, len(x)))
                x[p : p + int(rng.integers(0, 2))] = [str(rng.choice(list(letters)))] * int(rng.integers(0, 2))
            made.append((2000 + 20 * k + e, "".join(x)))
    got = line_dedup.dedup_lines(table(spark, made), edits=edits).withColumn("removed", F.array_join("removed", ","))
    allowed = lambda n: max((e for low, e in edits if n >= low), default=0)
    same(rows_of(got, "doc_id", "n_lines", "n_exact", "n_near", "removed"), plain.repeated_lines(made, allowed))


def test_edit_distance(spark):
    rng = np.random.default_rng(5)
    pairs = [("".join(rng.choice(list("ab"), rng.integers(0, 12))), "".join(rng.choice(list("ab"), rng.integers(0, 12)))) for _ in range(400)]
    for threshold in (1, 2, 3):
        got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.edit_distance("a", "b", threshold).alias("d")).collect()
        for r in got:
            d = plain.edits(r.a, r.b)
            assert r.d == d if d <= threshold else r.d > threshold, (r, d)


def test_token_files(spark, tmp_path):
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")

    def digests(rows, name):
        files = token_files.write_token_files(table(spark, rows), f"file://{tmp_path}/{name}")
        return token_files.token_file_digests(token_files.read_token_files(spark, f"file://{tmp_path}/{name}", files))

    same(rows_of(digests(ONCE, "a"), *columns), plain.token_digests(ONCE))
    whole = digests(plain.ROWS, "b")
    assert whole.count() == len(plain.ROWS)
    assert whole.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == whole.agg(F.sum("n_tokens")).first()[0]
    assert digests([], "c").count() == 0
    same(rows_of(queries.op8_token_files(spark, SF), *columns), plain.token_digests(DOCS))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, (1 << 64) - 1)), max_size=900))
def test_words_unpack_to_what_was_packed(values):
    packed = token_files.pack(np.array(values, np.uint64))
    assert token_files.unpack(*packed, len(values)).tolist() == values
    raw = token_files.segment([1, None, 7], np.array([len(values), 0, 0]), np.array(values, np.uint64))
    ids, lengths, back = token_files.read_segment(raw)
    assert ids == [1, None, 7] and lengths.tolist() == [len(values), 0, 0] and back.tolist() == values


def test_byte_bpe(spark):
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    same(rows_of(bpe.bpe_digests(table(spark, plain.ROWS)), *columns), plain.byte_bpe(plain.ROWS))
    same(rows_of(queries.op10_byte_bpe(spark, SF), *columns), plain.byte_bpe(DOCS))
    for r in bpe.bpe_encode(table(spark, plain.ROWS)).collect():
        assert bytes(r.decoded).decode() in {t or "" for _, t in plain.ROWS}


def test_long_pieces(spark):
    rng = np.random.default_rng(8)
    rows = [(1, "".join(rng.choice(list("acgt"), 60000))), (2, "".join(rng.choice(list("abcdefghij"), 3000))), (3, "ab" * 5000), (4, "a" * 9999)]
    same(rows_of(bpe.bpe_digests(table(spark, rows)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), plain.byte_bpe(rows))


def test_forward_backward_sums_over_all_paths():
    rng = np.random.default_rng(6)
    first, trans = np.array([0, 1, 5, 8]), rng.normal(size=(2, 2))
    node = rng.normal(size=(8, 2))
    p, pairs, log_z = quality_crf.forward_backward(node, trans, first)
    want_pairs = np.zeros((2, 2))
    for k, (a, b) in enumerate(itertools.pairwise(first.tolist())):
        weights = {}
        for path in itertools.product((0, 1), repeat=b - a):
            weights[path] = np.exp(sum(node[a + i, s] for i, s in enumerate(path)) + sum(trans[x, y] for x, y in itertools.pairwise(path)))
        z = sum(weights.values())
        assert np.isclose(np.log(z), log_z[k])
        for i in range(b - a):
            assert np.isclose(p[a + i, 1], sum(w for path, w in weights.items() if path[i]) / z)
        for path, w in weights.items():
            for x, y in itertools.pairwise(path):
                want_pairs[x, y] += w / z
    assert np.allclose(pairs, want_pairs)


def test_quality(spark):
    got = queries.op9_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(got) > 80 and np.mean([r.predicted == r.quality for r in got]) > 0.95
    docs = table(spark, plain.ROWS)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(1, 23)] + [(3, None, "x"), (None, 1, "x"), (4, 1, "x")], "doc_id bigint, quality int, id string")
    out = quality_crf.classify(docs, quality_crf.train(docs, labels)).collect()
    assert len(out) == len(plain.ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    none = quality_crf.classify(docs, quality_crf.train(docs, labels.limit(0)))
    assert none.count() == len(plain.ROWS)
    empty = docs.limit(0)
    assert quality_crf.classify(empty, quality_crf.train(empty, labels)).count() == 0
    often = spark.createDataFrame([(7, f"text {i}\nof this id") for i in range(500)] + [(8, "line\n" * 600), (9, "other")], "doc_id bigint, text string")
    two = spark.createDataFrame([(7, 1), (8, 0), (9, 0), (10, 0)], "doc_id bigint, quality int")
    seen = []
    fit, quality_crf.fit = quality_crf.fit, lambda x, size, first, label: seen.append(len(label)) or fit(x, size, first, label)
    try:
        quality_crf.train(often, two)
    finally:
        quality_crf.fit = fit
    assert seen[0] <= 2  # a row an id, and none for the document of 600 lines


def test_quality_learns_from_no_held_out_row(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_crf.train(docs, labels), quality_crf.train(docs, turned)
    assert np.array_equal(a.weights, b.weights) and (a.stretch, a.shift) == (b.stretch, b.shift)


def test_sketch_never_counts_too_little(spark):
    keys = np.random.default_rng(7).integers(0, 5000, 20000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = spark.createDataFrame([(int(x),) for x in keys.view(np.int64)], "k bigint").repartition(5)
    pages = sketch.repeated_slots(rows, lambda batches: (b.column("k").to_numpy().view(np.uint64) for b in batches), 20)
    value, n = np.unique(keys, return_counts=True)
    assert sketch.Repeated(pages, 20)(value[n > 1]).all()


def test_empty_tables(spark):
    docs = table(spark, plain.ROWS).limit(0)
    items = spark.createDataFrame(plain.ITEMS, "item_id string, text string")
    for made in (
        token_counts.token_counts(docs), decontaminate.decontaminate(docs, items), substring_dedup.dedup_windows(docs), suffix_dedup.dedup_bytes(docs), simhash.simhash_groups(docs),
        line_dedup.dedup_lines(docs), line_dedup.without_repeated_lines(docs), bpe.bpe_encode(docs), bpe.bpe_digests(docs),
    ):
        assert made.count() == 0


def test_words_do_not_cross_rows():
    flat, offs = common.flat_bytes(pa.array(["ab", "cd e", "", None, " f"]))
    space = np.zeros(256, bool)
    space[32] = True
    start, end, first = common.word_spans(flat, offs, ~space)
    assert [flat[a:b].tobytes() for a, b in zip(start, end, strict=True)] == [b"ab", b"cd", b"e", b"f"] and first.tolist() == [0, 1, 3, 3, 3, 4]
