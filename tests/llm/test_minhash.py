"""MinHash near-duplicates against the similarity of all pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from keyloom.llm import common, minhash, queries, simhash
from keyloom.llm.shingles import Shingles
from pyspark.sql import functions as F

from . import plain

SF = "/root/testdata/sf0.01"


def groups(rows, words=5, percent=85):
    sets = []
    for _, t in rows:
        w = plain.words_of(plain.lowered(t), rb"[^\x20\x09-\x0D]+")
        sets.append(frozenset(tuple(w[a : a + words]) for a in range(max(1, len(w) - words + 1))) if w else frozenset())
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    having = {}
    for s in root:
        for x in s:
            having.setdefault(x, []).append(s)
    seen = set()
    for many in having.values():
        for a, b in combinations(many, 2):
            if (id(a), id(b)) not in seen:
                seen.add((id(a), id(b)))
                if 100 * len(a & b) >= percent * len(a | b):
                    root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        top = find(s) if s else None
        if i is not None:
            least[top] = min(i, least.get(top, i))
    named = [(i, len(s), (least.get(find(s)) if s else i)) for (i, _), s in zip(rows, sets, strict=True)]
    return sorted([(i, n, c, i == c) for i, n, c in named], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_minhash_of_awkward_rows(spark):
    rows = [*plain.ROWS, (40, "a b c d e f g h i j"), (41, "A b  c d e f g h i\nj"), (42, "a b c d e f g h i j k"), (43, "a b c d e f g h i j k l"), (None, "only a null id names this text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).select("doc_id", *[F.lit(c).alias(c) for c in plain.CLASHES if c != "doc_id"], F.lit(1).alias("bucket"), F.lit(1).alias("node"), "text")
    assert got(minhash.minhash_groups(df)) == groups(rows)
    assert minhash.minhash_groups(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        minhash.minhash_groups(df, percent=80)


def test_minhash_of_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    assert got(queries.op12_minhash(spark, SF)) == groups(rows)


@pytest.mark.parametrize("part", [4096, 7])
def test_minhash_of_edited_texts(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)  # 7: buckets are cut into parts
    monkeypatch.setattr(simhash, "PART_SHINGLES", 60 * part)
    monkeypatch.setattr(common, "HOT", 9)
    rng = np.random.default_rng(8)
    vocabulary, rows = [f"w{i}" for i in range(300)], []
    shared = [str(x) for x in rng.choice(vocabulary, 60)]
    for k in range(14):  # chains of edits: neighbours are similar, ends are not; all hold one passage
        text = shared + [str(x) for x in rng.choice(vocabulary, int(rng.integers(6, 90)))]
        for _ in range(12):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(int(rng.integers(0, 3))):
                text[int(rng.integers(0, len(text)))] = str(rng.choice(vocabulary))
    rows += [(i + 1000, t) for i, t in rows[:5]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = groups(rows)
    assert 3 < len({c for _, _, c, _ in want}) < len(rows)
    assert got(minhash.minhash_groups(df)) == want


def test_members_that_only_their_center_keeps_apart(spark, monkeypatch):
    """Every text in one bucket: a star alone would lose the pairs without its center."""
    monkeypatch.setattr(minhash, "band_keys", lambda bins: np.zeros((len(bins), minhash.BANDS), np.uint64))
    test_minhash_of_edited_texts(spark, monkeypatch, 7)


@pytest.mark.parametrize("n", [6, 30, 400])
def test_bins_agree_as_often_as_sets(n):
    """Of densified bins too, the share that agrees is the similarity."""
    rng, agreed = np.random.default_rng(n), []
    for _ in range(60):
        both, own = rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, max(1, n // 6), np.uint64)
        gram = np.concatenate([both, both, own])
        bins = minhash.signatures(np.repeat([0, 1], [n, n + len(own)]), gram, 2)
        agreed.append((bins[0] == bins[1]).mean())
    assert abs(np.mean(agreed) - n / (n + max(1, n // 6))) < 0.02
    empty = Shingles(pa.RecordBatch.from_pydict({"text": ["", "one"]}), 5)
    bins = minhash.signatures(empty.row, empty.gram, 2)
    assert (bins[0] == bins[0, 0]).all() and (bins[1] == bins[1, 0]).all() and bins[1, 0] < 1 << 32
