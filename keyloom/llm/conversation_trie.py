"""Operator 11: the trie of conversations that share their first turns.

Turns are dictionary-encoded, so that a conversation is a string of ids and equal conversations are one string.
The strings are partitioned by most significant digit: every bucket (a shared prefix) that is too large for one
task is split by its next id, after the ids that all its strings still share, and recursion goes on in those of
its parts that are too large again. Smaller parts go to tasks whole, which finish them by multikey quicksort; a
node is put out wherever the recursion, distributed or local, finds one."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checkpointed
from .simhash import _by_bucket

#: Different conversations of a bucket that a task finishes by itself; larger ones where FANOUT of these are too few.
LOCAL = 256
#: A dictionary entry that holds more than this share of all turns is broadcast, so at most this many are.
HEAVY = 1000
#: Large buckets of a round, at most: LOCAL grows with the input beyond FANOUT * LOCAL conversations.
FANOUT = 1 << 16
#: Ids in a packed row of a node's members.
PACK = 1 << 14
_NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, path binary, bucket bigint, level bigint"
_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, sym, bytes): each row with the dictionary's id of its role and text, and the text's UTF-8
    bytes. Ids rise with the SHA-256 digest of role and text. Rows with a null conv_id are left out; null roles and
    texts are empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    found = rows.groupBy("digest").agg(F.count("*").alias("many")).repartitionByRange("digest").sortWithinPartitions("digest")
    dictionary = checkpointed(found.withColumn("sym", F.monotonically_increasing_id()))
    total = dictionary.agg(F.sum("many")).first()[0] or 0
    heavy = dictionary.filter(F.col("many") * HEAVY > total).select("digest", F.col("sym").alias("frequent"))  # fewer than HEAVY rows
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    known = marked.filter("frequent is not null").select("conv_id", "turn", F.col("frequent").alias("sym"), "bytes")
    others = marked.filter("frequent is null").join(dictionary.filter(F.col("many") * HEAVY <= total).select("digest", "sym"), "digest")
    return known.union(others.select("conv_id", "turn", "sym", "bytes"))


def rebuilt(turns: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """(conv_id, syms, sizes): every conversation c as the first h turns of conversation c - c % family and its own
    turns after its first h, where h is the CRC-32 of c in decimal modulo most + 1. Turns go by number, nulls first;
    those with one number by the digest of role and text. One conversation's ids are one row."""
    base = F.col("conv_id") - F.col("conv_id") % family
    own = turns.withColumn("base", base).repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "sym", "bytes"))).alias("own"))
    heads = own.filter("conv_id = base").select("base", F.slice("own", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    first = F.coalesce(F.slice("head", F.lit(1), h), F.slice("own", 1, 0))
    path = F.concat(first, F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return own.join(heads, "base", "left").select("conv_id", path.alias("path")).select("conv_id", F.col("path.sym").alias("syms"), F.col("path.bytes").alias("sizes"))


def _packed(batches):
    """(path, first, ids): the ids of each path, which come sorted, as decimals joined by commas, PACK in a row."""
    path, ids, out = None, [], []
    kind = pa.schema([("path", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    for b in batches:
        for p, c in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if ids and (p != path or len(ids) == PACK):
                out.append({"path": path, "first": ids[0], "ids": ",".join(map(str, ids))})
                ids = []
            path = p
            ids.append(c)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, kind)
            out = []
    if ids:
        out.append({"path": path, "first": ids[0], "ids": ",".join(map(str, ids))})
    yield pa.RecordBatch.from_pylist(out, kind)


def _hashed(batches):
    """SHA-256 of each path's packed ids, which come in order."""
    path, digest, out = None, None, []
    kind = pa.schema([("path", pa.binary()), ("ends_sha256", pa.string())])
    for b in batches:
        for p, ids in zip(b.column("path").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if p != path:
                if digest is not None:
                    out.append({"path": path, "ends_sha256": digest.hexdigest()})
                path, digest = p, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, kind)
            out = []
    if digest is not None:
        out.append({"path": path, "ends_sha256": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, kind)


def ends(strings: DataFrame) -> DataFrame:
    """(path, ends_sha256) of (path, conv_id): equal strings may be a third of all, so their ids are sorted by range,
    packed where they are, and only the packed rows of a path meet in one task."""
    packed = strings.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_packed, "path binary, first bigint, ids string")
    return packed.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_hashed, "path binary, ends_sha256 string")


class _Local:
    """Buckets of strings that a task finishes: multikey quicksort, which compares one id at a time, with a stack.

    A segment of strings that agree so far is split around one of their next ids; the middle part, which has that
    id, is a node. A string that is alone is put aside with the place where it left the others."""

    def __init__(self, t: pa.Table, group: np.ndarray):
        column = lambda c: t.column(c).to_numpy()
        syms, sizes = (t.column(c).combine_chunks() for c in ("syms", "sizes"))
        syms, sizes = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (syms, sizes))
        self.at = syms.offsets.to_numpy().astype(np.int64)
        self.sym = syms.values.to_numpy()
        self.total = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())])
        self.shift = sizes.offsets.to_numpy().astype(np.int64)[:-1] - self.at[:-1]
        self.length = np.diff(self.at)
        self.least, self.n, self.bucket, self.level = (column(c) for c in ("least", "n", "bucket", "level"))
        self.path = t.column("path").combine_chunks()
        self.parent, self.depth, self.row, self.low, self.many = [], [], [], [], []  # nodes
        self.end: dict[int, int] = {}
        self.tails: list[tuple[int, int, int]] = []  # (string, depth, node)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        last = np.concatenate([first[1:], [len(group)]])
        alone = last - first == 1
        self.single = first[alone]
        self._sort([(int(a), int(b), 0, -1) for a, b in zip(first[~alone], last[~alone], strict=True)])

    def _sort(self, stack: list) -> None:
        order = np.arange(len(self.n))
        while stack:
            lo, hi, d, node = stack.pop()
            rows = order[lo:hi]
            if hi - lo == 1:
                r = int(rows[0])
                if self.length[r] > d:
                    self.tails.append((r, d, node))
                else:
                    self.end[node] = r
                continue
            s = np.where(self.length[rows] > d, self.sym[np.minimum(self.at[rows] + d, len(self.sym) - 1)], -1)
            pivot = np.sort(s[[0, len(s) // 2, -1]])[1]
            less, more = s < pivot, s > pivot
            same = rows[~(less | more)]
            order[lo:hi] = np.concatenate([rows[less], same, rows[more]])
            a = lo + int(less.sum())
            b = a + len(same)
            if a > lo:
                stack.append((lo, a, d, node))
            if hi > b:
                stack.append((b, hi, d, node))
            if len(same) == 1:
                stack.append((a, b, d, node))
            else:  # strings are different, so these have a next id
                self.parent.append(node)
                self.depth.append(d + 1)
                self.row.append(int(same[0]))
                self.low.append(int(self.least[same].min()))
                self.many.append(int(self.n[same].sum()))
                stack.append((a, b, d + 1, len(self.parent) - 1))

    def _bytes(self, row, frm, to):
        """Bytes of the turns of strings from one depth to another."""
        at = self.at[row] + self.shift[row]
        return self.total[at + to] - self.total[at + frm]

    def nodes(self):
        parent, depth, row, low, many = (np.array(x, np.int64) for x in (self.parent, self.depth, self.row, self.low, self.many))
        tail = np.array(self.tails, np.int64).reshape(-1, 3)
        tail = np.concatenate([tail, np.stack([self.single, np.zeros(len(self.single), np.int64), np.full(len(self.single), -1)], 1)])
        r, d, above = tail.T
        children, leaves = np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64)
        saved = (many - 1) * self._bytes(row, depth - 1, depth)
        inside, below = above >= 0, parent >= 0
        np.add.at(children, above[inside], 1)
        np.add.at(children, parent[below], 1)
        np.add.at(leaves, above[inside], 1)
        np.add.at(saved, above[inside], ((self.n[r] - 1) * self._bytes(r, d, self.length[r]))[inside])
        for k in range(len(parent) - 1, -1, -1):  # nodes come after their parents
            if parent[k] >= 0:
                leaves[parent[k]] += leaves[k]
                saved[parent[k]] += saved[k]
        paths = self.path.to_pylist()
        upper = np.where(below, low[parent] if len(low) else 0, self.bucket[row] if len(row) else 0)
        if len(parent):
            ended = [paths[self.end[k]] if k in self.end else None for k in range(len(parent))]
            yield self._made(low, depth + self.level[row], upper, many, children, leaves, saved, ended, row, ~below)
        m = self.length[r] - d
        t = np.repeat(np.arange(len(r)), m)  # a node a turn of each tail
        step = np.arange(len(t)) - np.repeat(np.cumsum(m) - m, m)
        rt = r[t]
        top, last = step == 0, step == m[t] - 1
        start = np.where(inside, low[above] if len(low) else 0, self.bucket[r])
        worth = (self.n[rt] - 1) * self._bytes(rt, d[t] + step, self.length[rt])
        ended = [paths[x] if z else None for x, z in zip(rt.tolist(), last.tolist(), strict=True)]
        yield self._made(self.least[rt], self.level[rt] + d[t] + step + 1, np.where(top, start[t], self.least[rt]), self.n[rt], (~last).astype(np.int64), np.ones(len(t), np.int64), worth, ended, rt, top & ~inside[t])

    def _made(self, conv, depth, parent, n, children, leaves, saved, ended, row, top):
        bucket, level = (pa.array(x[row], mask=~top) for x in (self.bucket, self.level))
        return pa.RecordBatch.from_arrays([*map(pa.array, (conv, depth, parent, n, children, leaves, saved)), pa.array(ended, pa.binary()), bucket, level], names=[*_COLUMNS, "path", "bucket", "level"])


def _finished(t, group):
    yield from _Local(t, group).nodes()


def _next() -> Column:
    return F.get("syms", F.col("level").cast("int"))


def _shared() -> Column:
    """How many ids the least and the greatest string of a bucket, and so all its strings, begin with."""
    m = F.least(F.size("low"), F.size("high"))
    differ = F.array_position(F.transform(F.sequence(F.lit(1), m), lambda i: F.get("low", i - 1) == F.get("high", i - 1)), False)
    return F.when(differ > 0, differ - 1).otherwise(m).cast("bigint")


def trie(strings: DataFrame, local: int = LOCAL) -> DataFrame:
    """A row a node of the trie of (conv_id, syms, sizes): see conversation_trie."""
    spark = strings.sparkSession
    bounded_batches(spark)
    path = F.unhex(F.sha2(F.concat_ws(",", F.col("syms").cast("array<string>")).cast("binary"), 256))
    strings = checkpointed(strings.withColumn("path", path))
    groups = checkpointed(strings.groupBy("path", "syms", "sizes").agg(F.min("conv_id").alias("least"), F.count("*").alias("n")))
    count, least, members = groups.agg(F.count("*"), F.min("least"), F.sum("n")).first()
    local = max(local, -(-count // FANOUT))
    # a bucket: its smallest member and depth (bucket, level), those of the bucket above, the bytes of the turns that
    # lead from there, and all buckets above it with itself
    level = lambda x: F.lit(x).cast("bigint")
    top = spark.range(1 if count else 0).select(level(least).alias("bucket"), level(0).alias("level"), level(None).alias("above"), level(-1).alias("above_level"), level(members).alias("members"), F.array(level(0)).alias("chain"))
    buckets = [top.withColumn("all", F.array(F.struct("bucket", "level")))]
    active = groups.select(level(least).alias("bucket"), level(0).alias("level"), *groups.columns)
    rest, ended = [], []
    while True:
        here = active.filter(F.size("syms") > F.col("level")).withColumn("sym", _next())
        ended.append(active.filter(F.size("syms") == F.col("level")).select("bucket", "level", F.col("path").alias("ended")))
        keys = ["bucket", "level", "sym"]
        large = checkpointed(here.groupBy(*keys).agg(F.count("*").alias("many")).filter(F.col("many") > local).select(*keys))
        if not large.head(1):
            rest.append(here)
            break
        inside = here.join(F.broadcast(large), keys)  # at most FANOUT rows
        split = inside.groupBy(*keys).agg(F.min("least").alias("to"), F.sum("n").alias("members"), F.min("syms").alias("low"), F.max("syms").alias("high"), F.min(F.struct("syms", "sizes")).alias("lowest"))
        split = split.withColumn("to_level", _shared())
        chain = F.slice("lowest.sizes", (F.col("level") + 1).cast("int"), (F.col("to_level") - F.col("level")).cast("int"))
        made = checkpointed(split.select(*keys, "to", "to_level", "members", chain.alias("chain")))
        up = buckets[-1].select("bucket", "level", "all")
        below = made.join(up, ["bucket", "level"]).select(F.col("to").alias("bucket"), F.col("to_level").alias("level"), F.col("bucket").alias("above"), F.col("level").alias("above_level"), "members", "chain", F.concat("all", F.array(F.struct(F.col("to").alias("bucket"), F.col("to_level").alias("level")))).alias("all"))
        buckets.append(checkpointed(below))
        rest.append(here.join(F.broadcast(large), keys, "left_anti"))
        active = checkpointed(here.join(F.broadcast(made.select(*keys, "to", "to_level")), keys).select(F.col("to").alias("bucket"), F.col("to_level").alias("level"), *groups.columns))
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].union(union(parts[1:]))
    cut = [F.slice(c, (F.col("level") + 1).cast("int"), (F.size(c) - F.col("level")).cast("int")).alias(c) for c in ("syms", "sizes")]
    parts = union([r.select("bucket", "level", "sym", "path", "least", "n", *cut) for r in rest])
    keys = ["bucket", "level", "sym"]
    lower = checkpointed(parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_by_bucket(tuple(keys), _finished), _NODE))
    upper = _upper(union(buckets), lower, union(ended))
    nodes = upper.union(lower.select(*_COLUMNS, "path")).join(ends(strings), "path", "left")
    return nodes.select(*_COLUMNS, F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def _upper(buckets: DataFrame, lower: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes of the distributed recursion: those that lead to each large bucket."""
    buckets = checkpointed(buckets)
    chain = F.aggregate("chain", F.lit(0).cast("bigint"), lambda a, x: a + x)
    tops = lower.filter("bucket is not null").groupBy("bucket", "level").agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    own = buckets.join(tops, ["bucket", "level"], "left").na.fill(0, ["kids", "leaves", "saved"])
    # what lies below a bucket's own node: local parts count for it and all above, the turns leading to it for those above
    each = own.withColumn("b", F.explode("all"))
    itself = (F.col("b.bucket") == F.col("bucket")) & (F.col("b.level") == F.col("level"))
    below = each.groupBy(F.col("b.bucket").alias("bucket"), F.col("b.level").alias("level")).agg(F.sum("leaves").alias("leaves"), F.sum(F.col("saved") + F.when(itself, 0).otherwise((F.col("members") - 1) * chain)).alias("saved"))
    kids = own.select("bucket", "level", "kids").union(own.filter("above is not null").select(F.col("above"), F.col("above_level"), F.lit(1).cast("bigint"))).groupBy("bucket", "level").agg(F.sum("kids").alias("kids"))
    key = ["bucket", "level"]
    whole = buckets.join(below, key).join(kids, key).join(ended, key, "left")
    step = whole.select("*", F.posexplode("chain").alias("k", "size"))
    depth = F.col("above_level") + 1 + F.col("k")
    last = F.col("k") == F.size("chain") - 1
    later = F.aggregate(F.slice("chain", F.col("k") + 1, F.size("chain") - F.col("k")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return step.select(
        F.col("bucket").alias("conv_id"), depth.alias("depth"), F.when(F.col("k") == 0, F.col("above")).otherwise(F.col("bucket")).alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.when(last, F.col("kids")).otherwise(1).alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"), (F.col("saved") + (F.col("members") - 1) * later).alias("saved_tokens"), F.when(last, F.col("ended")).alias("path"),
    )


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """A row a node: conv_id (its smallest member), depth, parent_conv_id (its parent's, null for the root), n_convs
    (conversations that begin with it), n_children, n_leaves (childless nodes of its subtree), saved_tokens (what one
    copy of each node of its subtree would save, in UTF-8 bytes) and ends_sha256 (of the ids of conversations that end
    in it, ascending, joined by commas).

    Conversations are rebuilt with the first turns of another (see rebuilt). Null turns come first; null roles and
    texts are empty ones; rows with a null conv_id are left out; rows of one turn go by the digest of role and text,
    and repeated rows are turns of their own. Texts of any length count as a digest; a conversation's ids are one row
    of 16 bytes a turn. An empty table has no node. Extra columns are left out."""
    return trie(rebuilt(encoded_turns(conversations)), local)
