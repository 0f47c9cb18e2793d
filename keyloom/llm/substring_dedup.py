"""Operator 3: removal of word windows that an earlier document has, behind a count-min prefilter.

First pass: every window of `window` words is counted under its key, the smallest hash of the sub-windows of
half its length (equal windows have equal keys), in count-min sketches; the partitions' sketches are added up.
A sketch only overestimates, so a window that it counts once occurs in one document and needs no grouping.
Second pass: the other windows are grouped exactly, by 128-bit hashes of their words. Neighbouring windows
with the same key travel as one run: runs are grouped first. Where a key has different runs, as a second sketch
of the distinct runs' keys tells without missing any, one occurrence of each is taken apart into its windows,
which are grouped again; a key's only run has windows that no other run has."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BASES, bounded_batches, checkpointed, flat_bytes, fmix, slices, sliding_argmin, span_hashes, window_hashes, word_spans
from .sketch import SKETCH_BITS, Repeated, repeated_slots

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Windows:
    """Words and windows of a slice of rows. Indexes are of words of the whole slice."""

    def __init__(self, batch, window: int):
        self.flat, offs = flat_bytes(batch.column("text"))
        self.starts, self.ends, self.first = word_spans(self.flat, offs, ~_SPACE)
        self.words = [span_hashes(self.flat, self.starts, self.ends, seed) for seed in (0, 7)]
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        n, half = len(self.row), max(1, window // 2)
        self.at = np.zeros(0, np.int64)
        if n >= window:
            self.at = np.flatnonzero(self.row[: n - window + 1] == self.row[window - 1 :])
            grams = window_hashes(self.words[0], half, WORD_BASES[0])
            self.chosen = sliding_argmin(grams, window - half + 1)[self.at]
            self.key = grams[self.chosen]

    def hashes(self, size: int, which: int) -> np.ndarray:
        return window_hashes(self.words[which], size, WORD_BASES[which])

    def span_hash(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hashes of runs of words, each word mixed with its place in the run."""
        size = end - start
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        mixed = fmix(self.words[which][place + np.repeat(start, size)] + place.astype(_U) * _U(WORD_BASES[which]))
        return fmix(np.add.reduceat(mixed, np.cumsum(size) - size) + size.astype(_U))


def _keys(window: int):
    """Arrays of the keys of a partition's windows; a document counts a key once."""

    def run(batches):
        for b in slices(batches, "text"):
            w = Windows(b, window)
            if len(w.at):
                new = np.concatenate([[True], np.diff(w.chosen) != 0])
                doc, key = w.row[w.at[new]], w.key[new]
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                yield key[np.concatenate([[True], (np.diff(doc) != 0) | (key[1:] != key[:-1])])]

    return run


def _key_column(batches):
    """Arrays of the keys of distinct runs."""
    for b in batches:
        yield b.column("key").to_numpy().view(_U)


def _runs(window: int, bits: int, pages: dict[int, bytes], mixed: dict[int, bytes] | None = None):
    """The second pass over the texts: runs of neighbouring windows that have the same, repeated key. With the
    slots of keys of different runs (mixed), only theirs, with the hashes of their windows."""
    ids = [("id", pa.int64()), ("tie", pa.int64()), ("key", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()), ("size", pa.int32()), ("starts", pa.list_(pa.int32()))]
    kind = pa.schema(ids if mixed is None else [*ids, ("windows", pa.binary())])

    def run(batches):
        tests = [Repeated(p, bits) for p in (pages, mixed) if p is not None]
        for b in slices(batches, "text"):
            w = Windows(b, window)
            if not len(w.at):
                continue
            new = np.flatnonzero(np.concatenate([[True], (np.diff(w.chosen) != 0) | (np.diff(w.at) != 1)]))
            size = np.diff(np.concatenate([new, [len(w.at)]]))
            ok = np.logical_and.reduce([t(w.key[new]) for t in tests])
            new, size = new[ok], size[ok]
            if not len(new):
                continue
            start, row, key = w.at[new], w.row[w.at[new]], w.key[new]
            r1, r2 = (w.span_hash(start, start + size + window - 1, k) for k in (0, 1))
            order = np.lexsort((start, r2, r1, row))
            start, size, row, key, r1, r2 = (x[order] for x in (start, size, row, key, r1, r2))
            lead = np.concatenate([[True], (np.diff(row) != 0) | (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])])
            own = (start - w.first[row]).astype(np.int32)  # places within the document
            at = np.flatnonzero(lead)
            columns = [b.column(c).take(pa.array(row[at])) for c in ("id", "tie")]
            columns += [pa.array(x[at].view(np.int64)) for x in (key, r1, r2)]
            columns += [pa.array(size[at].astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.concatenate([at, [len(own)]]).astype(np.int32)), pa.array(own))]
            if mixed is not None:
                pair = np.stack([w.hashes(window, 0), w.hashes(window, 1)], 1)
                columns.append(pa.array([pair[s : s + n].tobytes() for s, n in zip(start[at].tolist(), size[at].tolist(), strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=kind)

    return run


def _single_windows(batches):
    """Runs taken apart: a row a distinct window of the run, with all its starts in the document."""
    kind = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("starts", pa.list_(pa.int32()))])
    for b in batches:
        if not b.num_rows:
            continue
        size = b.column("size").to_numpy().astype(np.int64)
        raw = np.frombuffer(b"".join(b.column("windows").to_pylist()), "<i8").reshape(-1, 2)
        row = np.repeat(np.arange(len(size)), size)
        off = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        ids = [b.column(c).take(pa.array(row)) for c in ("id", "tie")]
        places = b.column("starts")
        lens = np.diff(np.asarray(places.offsets))
        flat = np.asarray(places.flatten())
        if (lens == 1).all():
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32)), pa.array((flat[row] + off).astype(np.int32)))
        else:
            lists = places.to_pylist()
            own = pa.array([[p + o for p in lists[r]] for r, o in zip(row.tolist(), off.tolist(), strict=True)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*ids, pa.array(raw[:, 0]), pa.array(raw[:, 1]), own], schema=kind)


def _kept(window: int):
    """Texts without the removed words, from (id, text, covered spans)."""

    def run(batches):
        kind = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        for b in slices(batches, "text"):
            flat, offs = flat_bytes(b.column("text"))
            starts, ends, first = word_spans(flat, offs, ~_SPACE)
            words, removed, kept = [], [], []
            for lo, hi, spans in zip(first[:-1].tolist(), first[1:].tolist(), b.column("spans").to_pylist(), strict=True):
                s, e = starts[lo:hi], ends[lo:hi]
                words.append(hi - lo)
                if spans:
                    change = np.zeros(hi - lo + 1, np.int64)
                    for x in spans:
                        at = np.asarray(x["starts"], np.int64)
                        np.add.at(change, at, 1)
                        np.add.at(change, at + x["size"] + window - 1, -1)
                    stay = np.cumsum(change)[:-1] == 0
                    removed.append(int((hi - lo) - stay.sum()))
                    s, e = s[stay], e[stay]
                else:
                    removed.append(0)
                kept.append(" ".join(flat[lo_:hi_].tobytes().decode() for lo_, hi_ in zip(s.tolist(), e.tolist(), strict=True)) if len(s) else "")
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["id", *kind.names])

    return run


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the words left, joined by one space).

    Words are what ASCII white space separates. A word goes if a window that covers it also starts in a row
    with a smaller id; windows are judged on the input. Null texts have no words. Rows of equal id do not count
    as smaller, so repeated rows of one id stay, and each of its texts is judged by itself; rows of null id have no
    order and stay whole. Tables that are empty, and texts of fewer words than a window, lose nothing; texts may be
    of any length. Ids are cast to bigint. Runs and windows whose two 64-bit hashes are equal count as equal."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    ordered = rows.filter("id is not null")
    pages = spark.sparkContext.broadcast(repeated_slots(ordered, _keys(window), sketch_bits))  # its size has a fixed bound

    fields = "id bigint, tie bigint, key bigint, r1 bigint, r2 bigint, size int, starts array<int>"

    def runs(batches):
        yield from _runs(window, sketch_bits, pages.value)(batches)

    def mixed_runs(batches):
        yield from _runs(window, sketch_bits, pages.value, mixed.value)(batches)

    found = ordered.mapInArrow(runs, fields)
    least = checkpointed(found.groupBy("r1", "r2").agg(F.min("id").alias("least"), F.min("key").alias("key")))
    mixed = spark.sparkContext.broadcast(repeated_slots(least.select("key"), _key_column, sketch_bits))  # as large as the other at most
    least = least.drop("key")
    later = found.join(least, ["r1", "r2"]).filter("id > least").select("id", "tie", "size", "starts")
    # a run's first holder: do its windows, one by one, start in a smaller document that has no such run?
    firsts = ordered.mapInArrow(mixed_runs, fields + ", windows binary").join(least, ["r1", "r2"]).filter("id = least")
    single = firsts.select("id", "tie", "size", "starts", "windows").mapInArrow(_single_windows, "id bigint, tie bigint, h1 bigint, h2 bigint, starts array<int>")
    first = single.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("h1", "h2", "least")
    alone = single.join(first, ["h1", "h2"]).filter("id > least").select("id", "tie", F.lit(1).alias("size"), "starts")
    spans = later.union(alone).distinct().groupBy("id", "tie").agg(F.collect_list(F.struct("size", "starts")).alias("spans"))
    whole = rows.join(spans.hint("shuffle_hash"), ["id", "tie"], "left").select("id", "text", "spans")
    kind = "id bigint, n_words bigint, n_removed bigint, kept string"
    return whole.mapInArrow(_kept(window), kind).withColumnRenamed("id", id_col)
