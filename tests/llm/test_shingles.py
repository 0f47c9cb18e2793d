"""The pipeline's near-duplicate stage against the Jaccard similarity of all pairs."""

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from keyloom.llm import shingles, simhash, sketch

from . import plain

SF = "/root/testdata/sf0.01"


def similar(rows, words=5, similarity=0.8):
    """(id, the smallest id of its group) of rows with distinct ids, none of them null."""
    sets, having, both = [], defaultdict(list), Counter()
    for _, t in rows:
        w = plain.words_of(plain.lowered(t), rb"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[a : a + words]) for a in range(max(1, len(w) - words + 1))} if w else set())
    for k, s in enumerate(sets):
        for x in s or [None]:
            both.update((other, k) for other in having[x])
            having[x].append(k)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for (a, b), n in both.items():
        if not sets[a] or 10 * n >= round(10 * similarity) * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, least[find(k)]) for k, (i, _) in enumerate(rows))


def test_near_duplicates_of_the_pipeline_are_all_that_brute_force_finds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    want = similar(rows)
    got = simhash.similar_groups(docs)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == want
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [i for i, c in want if i == c]


@pytest.mark.parametrize("part", [4096, 7])
def test_similar_groups_of_edited_texts(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)  # 7: buckets are cut into parts
    monkeypatch.setattr(simhash, "PART_SHINGLES", 60 * part)
    rng = np.random.default_rng(6)
    vocabulary, rows = [f"w{i}" for i in range(400)], [(1, ""), (2, " \n"), (3, "one"), (4, "One"), (5, "one two")]
    passage = [str(x) for x in rng.choice(vocabulary, 30)]
    for k in range(12):
        base = [*passage, *map(str, rng.choice(vocabulary, int(rng.integers(1, 90))))]
        for e in range(8):
            w = list(base)
            for p in rng.integers(0, len(w), int(rng.integers(0, 4))).tolist():
                w[p] = str(rng.choice(vocabulary))
            rows.append((100 + 10 * k + e, " ".join(w)))
    got = simhash.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == similar(rows)


def test_shingles_in_both_sets_block_by_block(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLE_BLOCK", 64)
    monkeypatch.setattr(simhash, "PAIR_BLOCK", 10)
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(900, int(n), replace=False)).astype(np.uint64) for n in rng.integers(0, 300, 40)]
    i, j = np.triu_indices(40, 1)
    got = simhash._in_both(pa.chunked_array([pa.array([x.tobytes() for x in sets], pa.binary())]), i, j)
    assert got.tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert simhash._in_both(pa.chunked_array([pa.array([b"", b""], pa.binary())]), i[:0], j[:0]).tolist() == []


def test_an_id_on_two_texts_keeps_the_clean_one(spark):
    words = [[f"{name}{i}" for i in range(60)] for name in "abc"]
    texts = [" ".join(w) for w in words]
    rows = [(1, texts[0]), (2, texts[0] + " end"), (2, texts[1]), (3, texts[2]), (3, texts[2] + " end"), (3, texts[2]), (None, texts[1]), (None, "alone"), (None, "alone"), (None, "Alone")]
    for part in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(part)
        kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
        assert len(kept) == 5 and {(1, texts[0]), (2, texts[1]), (None, "alone"), (None, "Alone")} <= set(kept)
        assert [t in (texts[2], texts[2] + " end") for i, t in kept if i == 3] == [True]


@pytest.mark.parametrize("bits", [8, 21])
def test_magnitudes_are_never_too_small_and_common_passages_leave_the_prefixes(spark, bits):
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([*passage, *(f"w{x}" for x in rng.integers(0, 10**9, 60))]) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in [*texts, "", "few words"]], "text string").repartition(3)
    often = sketch.Magnitudes(sketch.magnitudes(docs, shingles.all_keys(5), bits), bits)
    s = shingles.Shingles(pa.record_batch({"text": pa.array(texts)}), 5)
    gram, count = np.unique(s.gram, return_counts=True)
    assert (2.0 ** often(gram) >= count).all()
    key, at = s.ordered(often), s.prefix(0.8)
    assert all((np.diff(key[a:b].astype(np.int64)) > 0).all() for a, b in zip(s.first, s.first[1:], strict=False))
    if bits == 21:
        assert np.unique(key[at], return_counts=True)[1].max() == 1
    else:  # too small a sketch tells nothing apart, and is still an order
        assert len(at) == 18 * len(texts)
