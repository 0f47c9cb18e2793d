"""Operator 5: SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in few bits agree on some blocks of bits, so equal blocks bring candidates together.
Within such a bucket fingerprints are stored as vertical bit planes, 64 to a machine word: each query adds a
plane's differences to 64 counters at once by carry-save adders, and drops a word of 64 as soon as all of
its distances exceed the radius."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checkpointed, slices
from .components import connected_components
from .shingles import FP_WORDS, LEADS, all_keys, prefix_keys, prefix_rows, set_nodes, shingle_bits, similar_sets, twice, whole_sets
from .sketch import magnitudes, repeated_slots

#: Fingerprints of a bucket that are compared in one group; larger buckets are split into pairs of parts.
PART = 4096
#: Shingles of a bucket whose whole sets are compared in one group.
PART_SHINGLES = 1 << 20
#: Of the 256 bits of a set's fingerprint, those that sets of similarity 0.8 may differ in: ones of LARGE shingles or
#: more differ in 0.152 of them on average, smaller ones in up to 3/16 (5 shingles against 4), and 4.5 standard
#: deviations are added to that. Then the bits within which sets count as close to each other.
LARGE, SET_RADIUS, SMALL_RADIUS, SET_CLOSE = 32, 65, 76, 44
#: (query, word of 64) entries compared at once; different shingles and pairs of sets compared at once.
ENTRIES, SHINGLE_BLOCK, PAIR_BLOCK = 1 << 16, 1 << 12, 1 << 14
_U = np.uint64
_ALL = _U(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """64 bits, each 1 if set in over half the shingles' hashes; 0 for a text without words."""
    w = text.encode().lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)])
    n = max(1, len(w) - words + 1)
    starts, ends, digest = at[:n].tolist(), (at[min(words, len(w)) :] - 1)[:n].tolist(), xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 15):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[lo : lo + (1 << 15)], ends[lo : lo + (1 << 15)], strict=True)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint: the 64 bits) of every row; a null text has no words."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def tables_for(n: int, radius: int = 4, bucket: int = 1024) -> list[int]:
    """Bit masks such that fingerprints within the radius agree on all bits of at least one. The 64 bits are
    cut into blocks and each mask joins some: one more block and one more joined than needed make buckets
    smaller, so the choice keeps the expected bucket of n fingerprints below `bucket`."""
    for more in range(5):
        blocks = radius + 1 + more
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
        masks = [sum(c) for c in combinations(parts, 1 + more)]
        if n / 2 ** min(m.bit_count() for m in masks) <= bucket:
            break
    return masks


def _csa(a, b, c):
    """Carry-save adder: sum and carry of three bits, in every lane of a word."""
    ab = a ^ b
    return ab ^ c, (a & b) | (ab & c)


def _added(counter: list, over, planes):
    """Count eight more planes of differences into the bits of the counters; over: what they cannot hold."""
    one, two, four, *high = counter
    one, t1 = _csa(one, planes[0], planes[1])
    one, t2 = _csa(one, planes[2], planes[3])
    two, f1 = _csa(two, t1, t2)
    one, t1 = _csa(one, planes[4], planes[5])
    one, t2 = _csa(one, planes[6], planes[7])
    two, f2 = _csa(two, t1, t2)
    four, carry = _csa(four, f1, f2)
    for k, bit in enumerate(high):
        high[k], carry = bit ^ carry, bit & carry
    return [one, two, four, *high], over | carry


def _beyond(counter: list, over, radius: int):
    """The lanes whose counters are larger than the radius."""
    more, equal = over, _ALL
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            more, equal = more | (equal & counter[k]), equal & ~counter[k]
    return more


def close_pairs(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = 4, asks: np.ndarray | None = None):
    """Yield (i, j) index arrays of all pairs within the radius that share a group (rows sorted by group). fps: a
    fingerprint a row, of one 64-bit word or several.
    side: 0 rows meet all rows of their group with a higher index; 1 and 2 rows meet only the other side. Where
    asks is given, pairs have a row for which it is true, and those rows come first in their groups."""
    n = len(fps)
    parts = fps.reshape(n, -1)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([first, [n]]))
    pos = np.arange(n) - np.repeat(first, size)
    words = -(-size // 64)
    word0 = np.concatenate([[0], np.cumsum(words)])[:-1]
    word, lane = np.repeat(word0, size) + pos // 64, (pos % 64).astype(_U)
    begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if n else first
    planes = [np.bitwise_or.reduceat(((parts[:, b >> 6] >> _U(b & 63)) & _U(1)) << lane, begins) for b in range(64 * parts.shape[1])] if n else []
    filled = np.bitwise_or.reduceat(_U(1) << lane, begins) if n else np.zeros(0, _U)
    base = begins  # row index of a word's lane 0
    per = np.repeat(words, size) - pos // 64  # a row meets its own word and the later ones
    if asks is not None:
        per = np.where(asks, per, 0)
    last = np.cumsum(per)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(last, (last[at - 1] if at else 0) + ENTRIES, side="right")))
        q = np.repeat(np.arange(at, to), per[at:to])
        w = word[q] + np.arange(len(q)) - np.repeat(last[at:to] - per[at:to] - (last[at - 1] if at else 0), per[at:to])
        at = to
        over = np.zeros(len(q), _U)
        counter = [over] * max(3, radius.bit_length())
        for b in range(0, len(planes), 8):
            d = [planes[b + k][w] ^ (_U(0) - ((parts[q, (b + k) >> 6] >> _U((b + k) & 63)) & _U(1))) for k in range(8)]
            counter, over = _added(counter, over, d)
            far = _beyond(counter, over, radius)
            if b >= 16:
                live = (far & filled[w]) != filled[w]
                if not live.all():
                    q, w, over, far = (x[live] for x in (q, w, over, far))
                    counter = [x[live] for x in counter]
        near = ~far & filled[w] if len(q) else np.zeros(0, _U)
        hit = np.flatnonzero(near)
        if len(hit):
            bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            e, l = np.nonzero(bits)
            i, j = q[hit[e]], base[w[hit[e]]] + l
            ok = (j > i) & ((side[i] != side[j]) | (side[i] == 0))
            if ok.any():
                yield i[ok], j[ok]


def _spanning(n: int, pairs) -> tuple[np.ndarray, np.ndarray]:
    """At most one link a row that connects what all pairs connect."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (up := root[root]).tolist() != root.tolist() if n < 64 else not np.array_equal(up := root[root], root):
                root = up
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def _by_bucket(keys: tuple[str, ...], made):
    """Apply made(table, group of each row) to whole buckets of rows that come sorted by keys; a bucket's rows are
    kept until it ends."""

    def whole(t):
        new = np.zeros(t.num_rows, np.int64)
        if t.num_rows:
            cols = [t.column(k).to_numpy() for k in keys]
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in cols])
        return made(t, np.cumsum(new)) if t.num_rows else ()

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            same = np.logical_and.reduce([t.column(k).to_numpy() == t.column(k)[-1].as_py() for k in keys])
            cut = int(np.argmax(same))
            yield from whole(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None:
            yield from whole(held.combine_chunks())

    return run


def _dealt(keyed: DataFrame, keys: tuple[str, ...], name: str, whole: DataFrame | bool = False) -> DataFrame:
    """Rows of buckets (equal keys) of two rows or more, sorted by bucket; buckets of over PART rows (or, where whole
    sets travel, over PART_SHINGLES shingles, column n; given as a table, these sets are joined by `name` once rows are dealt) are cut into parts, by a hash of `name`, and every pair of
    parts is a bucket of its own (lo, hi; side tells the parts)."""
    share = F.greatest(F.count("*") / PART, F.sum("n") / PART_SHINGLES) if whole is not False else F.count("*") / PART
    full = keyed.groupBy(*keys).agg(F.count("*").alias("many"), F.ceil(share).cast("int").alias("parts")).filter("many > 1").select(*keys, "parts")
    dealt = keyed.join(full, list(keys)).withColumn("part", F.expr(f"cast(pmod(xxhash64({name}), parts) as int)"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other"), "side": F.expr("case when part = other then 0 when part < other then 1 else 2 end")})
    dealt = dealt.drop("parts", "part", "other")
    dealt = dealt.join(whole, name) if isinstance(whole, DataFrame) else dealt
    return dealt.repartition(*keys, "lo", "hi").sortWithinPartitions(*keys, "lo", "hi")


def _links(t, group):
    """Spanning links of the buckets."""
    fps = t.column("fp").to_numpy().view(np.uint64)
    a, b = _spanning(t.num_rows, close_pairs(fps, group, t.column("side").to_numpy()))
    yield pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], names=["a", "b"])


def near_fingerprints(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all pairs within the radius:
    not every pair, but at most one link a fingerprint and bucket."""
    masks = tables_for(distinct.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in signed])).alias("t", "key"))
    return _dealt(keyed, ("t", "key"), "fp").mapInArrow(_by_bucket(("t", "key", "lo", "hi"), _links), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (the smallest id that links of `radius` or fewer
    differing bits reach, itself included).

    A null, empty or blank text has fingerprint 0 and is linked like any other. Equal fingerprints, as of
    repeated rows, are one node; null ids get a component but name none. An empty table gives an empty result."""
    fps = checkpointed(fingerprints(docs, id_col, text_col))
    nodes = fps.groupBy("fp").agg(F.min("id").alias("least"))
    found = connected_components(near_fingerprints(nodes.select("fp"), radius), "a", "b").withColumnRenamed("node", "fp")
    placed = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(names, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


class _Bucket:
    """Nodes of buckets, those first in each that ask: all but the ones of a bucket's largest component, which are
    not compared with each other."""

    def __init__(self, t, group, similarity: float):
        component = t.column("component").to_numpy()
        order = np.lexsort((component, group))
        c, g = component[order], group[order]
        lead = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (g[1:] != g[:-1])]))
        many = np.diff(np.concatenate([lead, [len(c)]]))
        largest = np.zeros(group[-1] + 1, np.int64)
        np.maximum.at(largest, g[lead], many * len(lead) + np.arange(len(lead)))
        asks = component != c[lead][largest % len(lead)][group]
        asks |= (largest // len(lead) == 1)[group]  # each has a component of its own
        order = np.lexsort((~asks, group))
        self.t, self.asks, self.group, self.similarity = t.take(pa.array(order)), asks[order], group, similarity
        self.fps = np.stack([self.t.column(f"f{k}").to_numpy() for k in range(FP_WORDS)], 1).view(np.uint64)
        self.node, self.component, self.size, self.side = (self.t.column(x).to_numpy() for x in ("node", "component", "n", "side"))

    def pairs(self):
        """Pairs (i, j, distance) of different components, within the radius and of sizes that allow the similarity."""
        for i, j in close_pairs(self.fps, self.group, self.side, SMALL_RADIUS, self.asks):
            less, more = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
            ok = (self.component[i] != self.component[j]) & (less >= self.similarity * more - 1e-9)
            i, j, less = i[ok], j[ok], less[ok]
            apart = np.bitwise_count(self.fps[i] ^ self.fps[j]).sum(1, dtype=np.int64)
            ok = apart <= np.where(less < LARGE, SMALL_RADIUS, SET_RADIUS)
            yield i[ok], j[ok], apart[ok]


def _best_pairs(similarity: float):
    """(a, b, score): for each node that asks, of its pairs the one with the node that has most others close by (so
    many: score)."""

    def made(t, group):
        bucket = _Bucket(t, group, similarity)
        n = len(bucket.node)
        degree, best = np.zeros(n, np.int64), np.full(n, -1)
        for i, j, apart in bucket.pairs():
            close = apart <= SET_CLOSE
            degree += np.bincount(i[close], minlength=n) + np.bincount(j[close], minlength=n)
        for i, j, _ in bucket.pairs():
            np.maximum.at(best, i, degree[j] * n + n - 1 - j)
            np.maximum.at(best, j, degree[i] * n + n - 1 - i)
        own = np.flatnonzero((best >= 0) & bucket.asks)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.node[own]), pa.array(bucket.node[n - 1 - best[own] % n]), pa.array(best[own] // n)], names=["a", "b", "score"])

    return _by_bucket(("gram", "lo", "hi"), made)


def _paired(similarity: float, columns: list[str]):
    """The nodes of a bucket that have a pair in it. A pair that shares one of both its LEADS smallest shingles is
    looked at in the bucket of the smallest such, and in no later one."""

    def made(t, group):
        bucket = _Bucket(t, group, similarity)
        gram = bucket.t.column("gram").to_numpy().view(np.uint64)
        leads = np.stack([bucket.t.column(f"l{k}").to_numpy() for k in range(LEADS)], 1).view(np.uint64)
        have = np.zeros(len(gram), bool)
        for i, j, _ in bucket.pairs():
            before = np.zeros(len(i), bool)
            for x in range(LEADS):
                same = np.logical_or.reduce([leads[i, x] == leads[j, y] for y in range(LEADS)])
                before |= same & (leads[i, x] < gram[i])
            have[i[~before]] = have[j[~before]] = True
        yield from bucket.t.select(columns).take(pa.array(np.flatnonzero(have))).combine_chunks().to_batches()

    return _by_bucket(("gram", "lo", "hi"), made)


def _in_both(sets: pa.ChunkedArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair have in common: bits of the shingles that several sets have, a block
    of them at a time."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = at[: len(i)], at[len(i) :]
    raw = [np.frombuffer(x.as_buffer(), _U) for x in sets.take(pa.array(used))]
    owner = np.repeat(np.arange(len(used)), [len(x) for x in raw])
    _, gram, many = np.unique(np.concatenate([np.zeros(0, _U), *raw]), return_inverse=True, return_counts=True)
    owner, gram = owner[many[gram] > 1], (np.cumsum(many > 1) - 1)[gram[many[gram] > 1]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    both = np.zeros(len(i), np.int64)
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, SHINGLE_BLOCK):
        lo, hi = np.searchsorted(gram, [low, low + SHINGLE_BLOCK])
        bits = np.zeros((len(used), SHINGLE_BLOCK), bool)
        bits[owner[lo:hi], gram[lo:hi] - low] = True
        bits = np.packbits(bits, axis=1).view(np.uint64)
        bits = bits[:, : -(-(int(gram[hi - 1]) - low + 1) // 64)]
        for k in range(0, len(i), PAIR_BLOCK):
            both[k : k + PAIR_BLOCK] += np.bitwise_count(bits[i[k : k + PAIR_BLOCK]] & bits[j[k : k + PAIR_BLOCK]]).sum(1, dtype=np.int64)
    return both


def _verified(similarity: float):
    """Spanning links of a bucket's pairs whose whole sets (grams) have the similarity."""

    def made(t, group):
        bucket = _Bucket(t, group, similarity)
        sets, size = bucket.t.column("grams"), bucket.size

        def similar():
            for i, j, _ in bucket.pairs():
                for k in range(0, len(i), PAIR_BLOCK << 4):
                    x, y = i[k : k + (PAIR_BLOCK << 4)], j[k : k + (PAIR_BLOCK << 4)]
                    both = _in_both(sets, x, y)
                    ok = both >= similarity * (size[x] + size[y] - both) - 1e-9
                    yield x[ok], y[ok]

        a, b = _spanning(t.num_rows, similar())
        yield pa.RecordBatch.from_arrays([pa.array(bucket.node[a]), pa.array(bucket.node[b])], names=["a", "b"])

    return _by_bucket(("gram", "lo", "hi"), made)


def _sets_of(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, grams) of the given distinct nodes: the whole sets, from the texts."""
    wanted = rows.sparkSession.sparkContext.broadcast(repeated_slots(nodes, twice))  # its size has a fixed bound
    return rows.mapInArrow(whole_sets(words, wanted), "node bigint, grams binary").join(nodes.hint("shuffle_hash"), "node").groupBy("node").agg(F.first("grams").alias("grams"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Per row: id, tie (a hash of the text), component_id (the smallest id that links of texts with that Jaccard
    similarity of their shingles or more reach, itself included), component_tie (the smallest hash of a text with
    that id in the group).

    Sets that similar share a shingle of their prefixes, so equal shingles there bring candidates together; prefixes
    take the rarest shingles first, by a sketch of how often each occurs. Within
    such a bucket their SimHashes are compared as bit planes, and what is within the radius is verified on the
    whole sets. Each node is first verified with the neighbour that has most others close by, in the bucket of its
    smallest shingle. Then every bucket with nodes of different components gets the whole sets of those that are
    within the radius of another component's, and verifies all such pairs itself: it puts out links that connect
    what is similar, never its pairs. Words are what ASCII white space separates, without the case of A-Z. Texts
    without words are linked to each other alone; texts may be of any length. Null ids get a component but name
    none. An empty table gives an empty result. Shingles and sets of equal 64-bit hashes count as equal."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    fields, leads = ["n", *[f"f{k}" for k in range(FP_WORDS)]], [f"l{k}" for k in range(LEADS)]
    bits = shingle_bits(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    often = spark.sparkContext.broadcast(magnitudes(rows, all_keys(words), bits))  # its size has a fixed bound
    nodes = checkpointed(rows.mapInArrow(set_nodes(words, often, bits), "id bigint, tie bigint, node bigint, " + ", ".join(f"{f} bigint" for f in [*fields, *leads])))
    prints = nodes.groupBy("node").agg(*[F.min(f).alias(f) for f in [*fields, *leads]])
    repeats = spark.sparkContext.broadcast(repeated_slots(rows, prefix_keys(words, similarity, often, bits)))  # its size has a fixed bound
    prefix = rows.mapInArrow(prefix_rows(words, similarity, often, bits, repeats), "gram bigint, node bigint").distinct()  # equal sets are one node
    met = prefix.groupBy("gram").agg(F.count("*").alias("many")).filter("many > 1").select("gram")
    there = checkpointed(prefix.join(met, "gram"))
    smallest = there.join(there.groupBy("node").agg(F.min("gram").alias("gram")), ["node", "gram"]).join(prints.select("node", *fields), "node").withColumn("component", F.col("node"))
    pairs = _dealt(smallest, ("gram",), "node").mapInArrow(_best_pairs(similarity), "a bigint, b bigint, score bigint").groupBy("a").agg(F.max_by("b", "score").alias("b"))
    pairs = checkpointed(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    sets = _sets_of(rows, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), words)
    for side, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("grams").alias(name)), side)
    links = checkpointed(pairs.select("a", "b", "x", "y").mapInArrow(similar_sets(similarity), "a bigint, b bigint"))
    first = connected_components(links, "a", "b")
    placed = there.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("gram")
    columns = ["gram", "node", "component", *fields]
    paired = _dealt(placed.join(mixed, "gram").join(prints, "node"), ("gram",), "node").mapInArrow(_paired(similarity, columns), ", ".join(f"{c} bigint" for c in columns))
    paired = checkpointed(paired.dropDuplicates(["gram", "node"]))
    more = _dealt(paired, ("gram",), "node", _sets_of(rows, paired.select("node").distinct(), words)).mapInArrow(_verified(similarity), "a bigint, b bigint")
    groups = connected_components(links.union(more), "a", "b")
    named = nodes.select("id", "tie", "node").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "tie"))).alias("least"))
    return named.join(names, "component").select(F.col("id").alias(id_col), "tie", F.col("least.id").alias("component_id"), F.col("least.tie").alias("component_tie"))
