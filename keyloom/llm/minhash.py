"""Operator 12: MinHash near-duplicates by one-permutation hashing.

One hash deals a document's shingles to bins and each bin keeps its smallest; an empty bin takes the value of the
first bin with one in an order of its own (optimal densification), so that any bin of two documents agrees with a
chance of their similarity. The bins of a band together are a bucket's key. A bucket's candidates are a star: every
member with the smallest one. Candidates are confirmed on whole sets. Where members of a bucket are still apart
after that, the task that has the bucket compares them itself, so that no pair that shares a bucket is lost."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checkpointed, fmix, join_by_hot_key, slices
from .components import connected_components
from .shingles import Shingles
from .simhash import PAIR_BLOCK, _by_bucket, _dealt, _in_both, _sets_of, _spanning

#: A key is ROWS bins, a document has BANDS keys: of two with a similarity of 0.85, no key is equal with a chance of
#: (1 - 0.85**5)**32 = 7e-9; of two with 0.9, of 4e-13.
ROWS, BANDS = 5, 32
BINS = ROWS * BANDS
#: Of all bins, those that agree at least where the similarity is 0.85: 136 expected, less 40 (over six deviations).
CLOSE = BINS * 3 // 5
#: Rows of a bucket whose bins are compared with those of all others at once.
BLOCK = 64
_U = np.uint64
_NONE = _U(1 << 32)
#: The bins in the order in which an empty one looks at them, a row a bin (any fixed order that differs by bin).
_PROBES = np.argsort(fmix(np.arange(BINS * BINS, dtype=_U) + _U(0x51ED270B)).reshape(BINS, BINS), axis=1)


def signatures(row: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """The values of the bins (32 bits each) of n rows' sets of hashes; rows without any keep a value that is none."""
    h = fmix(gram + _U(0xA0761D6478BD642F))
    at = ((h >> _U(32)) * _U(BINS)) >> _U(32)
    bins = np.full(n * BINS, _NONE, _U)
    np.minimum.at(bins, row * BINS + at.astype(np.int64), h & _U(0xFFFFFFFF))
    bins = bins.reshape(n, BINS)
    some = np.zeros(n, bool)
    some[row] = True
    r, b = np.nonzero((bins == _NONE) & some[:, None])
    filled = bins.copy()
    for k in range(BINS):
        if not len(r):
            break
        found = bins[r, _PROBES[b, k]]
        ok = found != _NONE
        filled[r[ok], b[ok]] = found[ok]
        r, b = r[~ok], b[~ok]
    return filled


def band_keys(bins: np.ndarray) -> np.ndarray:
    """A 64-bit key a band; it depends on the band's number."""
    parts = bins.reshape(len(bins), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = fmix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k] + _U(1))
    return key


def _signed(words: int):
    """(id, node, n, keys, bins): equal sets have equal nodes; keys of the bands, and the lowest byte of each bin."""

    def run(batches):
        for b in slices(batches, "text"):
            s = Shingles(b, words)
            n = len(s.n)
            bins = signatures(s.row, s.gram, n)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(band_keys(bins).view(np.int64).ravel()))
            low = pa.array([x.tobytes() for x in bins.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s.node), pa.array(s.n), keys, low], names=["id", "node", "n", "keys", "bins"])

    return run


def _similar(percent: int):
    """The candidates (a, b) whose whole sets (x, y) are similar enough."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run


class _Apart:
    """Buckets whose members are of several components; those of each bucket's largest one are not compared with
    each other."""

    def __init__(self, t: pa.Table, group: np.ndarray, percent: int):
        self.t, self.group, self.percent = t, group, percent
        self.node, self.component, self.size, self.side = (t.column(c).to_numpy() for c in ("node", "component", "n", "side"))
        raw = t.column("bins").combine_chunks()
        self.bins = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, BINS)

    def pairs(self):
        """(i, j) of different components, with sizes that allow the similarity and enough bins that agree."""
        edge = np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1], [True]]))
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            component, size, side = self.component[lo:hi], self.size[lo:hi], self.side[lo:hi]
            kinds, kind, many = np.unique(component, return_inverse=True, return_counts=True)
            if len(kinds) == 1:
                continue
            asks = kind != int(np.argmax(many))
            who = np.flatnonzero(asks)
            place = np.arange(hi - lo)
            for at in range(0, len(who), BLOCK):
                i = who[at : at + BLOCK]
                ok = (component[i, None] != component) & (~asks | (place > i[:, None])) & ((side[i, None] != side) | (side[i, None] == 0))
                ok &= 100 * np.minimum(size[i, None], size) >= self.percent * np.maximum(size[i, None], size)
                x, y = np.nonzero(ok)
                for k in range(0, len(x), PAIR_BLOCK):
                    a, b = i[x[k : k + PAIR_BLOCK]] + lo, y[k : k + PAIR_BLOCK] + lo
                    near = (self.bins[a] == self.bins[b]).sum(1) >= CLOSE
                    if near.any():
                        yield a[near], b[near]


def _paired(percent: int, columns: list[str]):
    """The members of a bucket that have a candidate in it."""

    def made(t, group):
        have = np.zeros(t.num_rows, bool)
        for a, b in _Apart(t, group, percent).pairs():
            have[a] = have[b] = True
        yield from t.select(columns).take(pa.array(np.flatnonzero(have))).combine_chunks().to_batches()

    return _by_bucket(("bucket", "lo", "hi"), made)


def _verified(percent: int):
    """Links that connect what the candidates of a bucket connect whose whole sets (grams) are similar enough."""

    def made(t, group):
        bucket = _Apart(t, group, percent)
        sets, size = bucket.t.column("grams"), bucket.size

        def similar():
            for a, b in bucket.pairs():
                both = _in_both(sets, a, b)
                ok = 100 * both >= percent * (size[a] + size[b] - both)
                yield a[ok], b[ok]

        a, b = _spanning(t.num_rows, similar())
        yield pa.RecordBatch.from_arrays([pa.array(bucket.node[a]), pa.array(bucket.node[b])], names=["a", "b"])

    return _by_bucket(("bucket", "lo", "hi"), made)


def star_candidates(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (bucket, node): the buckets of two nodes or more with their smallest (center) and number (many), and the
    candidates (a, b): each node of such a bucket with its center, once."""
    met = buckets.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("many")).filter("many > 1")
    there = checkpointed(buckets.join(met, "bucket"))
    return there, there.filter("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 85) -> DataFrame:
    """Per row: id, n_shingles (different shingles of `words` words), component_id (the smallest id that links of sets
    with a Jaccard similarity of `percent` hundredths or more reach, itself included), kept (whether they are equal).

    Words are what ASCII white space separates, without the case of A-Z; a text of fewer words is one shingle. A
    null, empty or blank text has none and is linked with nothing. Rows with equal sets are one node, so repeated
    rows cost no comparison; null ids get a component but name none, and are kept where no id names it. Texts of any
    length count whole. An empty table gives an empty result; other columns are left out. Shingles and sets of equal
    64-bit hashes count as equal; similarities below 0.85 need more keys than BANDS gives."""
    if percent < 85:
        raise ValueError("the bands are made for similarities of 0.85 and more")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = checkpointed(rows.mapInArrow(_signed(words), f"id {kind}, node bigint, n bigint, keys array<bigint>, bins binary"))
    facts = signed.filter("n > 0").groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("many"))
    nodes = signed.filter("n > 0").select("node", "n", "keys", "bins").dropDuplicates(["node"])
    there, star = star_candidates(nodes.select("node", F.explode("keys").alias("bucket")))
    star = checkpointed(star)
    sets = _sets_of(rows, star.select(F.col("a").alias("node")).union(star.select("b")).distinct(), words)
    pairs = star.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b").join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
    links = checkpointed(pairs.select("a", "b", "x", "y").mapInArrow(_similar(percent), "a bigint, b bigint"))
    first = connected_components(links, "a", "b")
    # what a star does not compare: members that are not its center
    placed = there.filter("many > 2").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = placed.filter("node <> center").groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    columns = ["bucket", "node", "component", "n", "bins"]
    kinds = "bucket bigint, node bigint, component bigint, n bigint, bins binary"
    met = placed.join(apart, "bucket").select("bucket", "node", "component").join(nodes.select("node", "n", "bins"), "node")
    found = checkpointed(_dealt(met, ("bucket",), "node").mapInArrow(_paired(percent, columns), kinds).dropDuplicates(["bucket", "node"]))
    whole = found.join(_sets_of(rows, found.select("node").distinct(), words), "node")
    more = _dealt(whole, ("bucket",), "node", whole=True).mapInArrow(_verified(percent), "a bigint, b bigint")
    groups = connected_components(links.union(more), "a", "b")
    named = facts.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = checkpointed(named.join(names, "component").select("node", "many", "component_id"))
    some = join_by_hot_key(signed.filter("n > 0").select("id", "node", "n"), by_node, "node")
    out = some.select("id", "n", "component_id").union(signed.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
