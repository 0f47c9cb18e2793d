"""Operator 2: benchmark decontamination by winnowing.

Documents and benchmark items keep the smallest k-gram hash of every window of consecutive k-grams. Two texts
that share `window` words share all k-grams of one such window and so keep the same fingerprint: no shared
span of that length is missed. Where a document's fingerprint is one of the benchmark's, the hit is extended
to all windows of words around it, and these are joined with the items' windows word for word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BASES, bounded_batches, checkpointed, flat_bytes, fmix, slices, sliding_argmin, span_hashes, window_hashes, word_spans

#: Bits of the filter of benchmark fingerprints at most (16 MB): with more items it lets more through to the join.
FILTER_BITS = 27
_PAGE = 15  # bits of the filter that one row holds, as a power of two
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words after lower-casing: digits, a-z and all bytes of characters beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _words(batch):
    flat, offs = flat_bytes(batch.column("text"))
    flat = _LOWER[flat]
    starts, ends, first = word_spans(flat, offs, _WORD)
    return flat, starts, ends, first, span_hashes(flat, starts, ends)


def _gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    return fmix(window_hashes(words, k, WORD_BASES[0]) + _U(k))


def _winnowed(words: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams kept of one text."""
    grams = _gram_hashes(words, k)
    at = np.unique(sliding_argmin(grams, window - k + 1))
    return at, grams[at]


def _item_windows(window: int, k: int):
    def run(batches):
        for b in slices(batches, "text"):
            flat, starts, ends, first, h = _words(b)
            rows = []
            for item, lo, hi in zip(b.column("id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                n = hi - lo
                if not n:
                    continue
                words = [flat[s:e].tobytes() for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict=True)]
                size = min(n, window)
                kept = _gram_hashes(h[lo:hi], n) if n < window else _winnowed(h[lo:hi], k, window)[1]
                rows.append({"id": item, "size": size, "windows": [b" ".join(words[i : i + size]).decode() for i in range(n - size + 1)], "prints": kept.view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("id", pa.string()), ("size", pa.int32()), ("windows", pa.list_(pa.string())), ("prints", pa.list_(pa.int64()))]))

    return run


def _slots(prints: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((prints * _U(m)) >> _U(64 - bits)).astype(np.int64) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _print_filter(prints: DataFrame) -> tuple[dict[int, bytes], int]:
    """Bit pages of a Bloom filter of the fingerprints, built where they are; its size has a fixed bound."""
    bits = min(FILTER_BITS, max(_PAGE, int(64 * prints.count()).bit_length()))

    def slots(batches):
        for b in batches:
            at = np.unique(np.concatenate(_slots(b.column("print").to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> _PAGE), pa.array((at & ((1 << _PAGE) - 1)).astype(np.int32))], names=["page", "bit"])

    def pages(batches):  # rows come sorted by page
        page, marks = None, np.zeros(1 << _PAGE, bool)
        for b in batches:
            at, bit = b.column("page").to_numpy(), b.column("bit").to_numpy()
            for p in np.unique(at):
                if p != page:
                    if page is not None:
                        yield pa.RecordBatch.from_pylist([{"page": page, "marks": np.packbits(marks).tobytes()}])
                    page, marks = int(p), np.zeros(1 << _PAGE, bool)
                marks[bit[at == p]] = True
        if page is not None:
            yield pa.RecordBatch.from_pylist([{"page": page, "marks": np.packbits(marks).tobytes()}])

    rows = prints.mapInArrow(slots, "page bigint, bit int").distinct().repartition("page").sortWithinPartitions("page").mapInArrow(pages, "page bigint, marks binary")
    return {r.page: bytes(r.marks) for r in rows.collect()}, bits  # at most 2**(FILTER_BITS - _PAGE) pages of 4 KB


def _doc_hits(window: int, k: int, short: list[int], pages: dict[int, bytes], bits: int):
    def run(batches):
        marks = np.zeros(1 << bits, bool)
        for p, raw in pages.items():
            marks[p << _PAGE : (p + 1) << _PAGE] = np.unpackbits(np.frombuffer(raw, np.uint8))

        def known(prints):
            a, b, c = _slots(prints, bits)
            ok = marks[a]
            ok[ok] = marks[b[ok]] & marks[c[ok]]
            return ok

        for b in slices(batches, "text"):
            flat, starts, ends, first, h = _words(b)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            found: list[tuple[int, np.ndarray]] = []  # window size, starts (word indexes of the slice)
            if len(h) >= window:
                grams = _gram_hashes(h, k)
                at = sliding_argmin(grams, window - k + 1)
                at = np.unique(at[row[: len(at)] == row[window - 1 :]])  # only windows within one text choose
                at = at[known(grams[at])]
                around = np.unique((at[:, None] - np.arange(window - k + 1)[None, :]).ravel())
                around = around[(around >= 0) & (around + window <= len(h))]
                found.append((window, around[row[around] == row[around + window - 1]]))
            for size in short:
                if len(h) >= size:
                    ok = known(_gram_hashes(h, size)) & (row[: len(h) - size + 1] == row[size - 1 :])
                    found.append((size, np.flatnonzero(ok)))
            hits: list[list] = [[] for _ in range(len(first) - 1)]
            for size, at in found:
                for i in at.tolist():
                    words = b" ".join(flat[s:e].tobytes() for s, e in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True))
                    r = row[i]
                    hits[r].append({"start": i - int(first[r]), "size": size, "window": words.decode()})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("window", pa.string())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tie"), pa.array(np.diff(first), pa.int64()), pa.array(hits, kind)], names=["id", "tie", "n_words", "hits"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """Per document: id, n_words, n_hit (words inside occurrences of item windows), n_items, items_sha256 (of the
    items' ids sorted as strings and joined by commas), contaminated, the ids themselves as items, and tie (a hash of the text).

    A window is `window` consecutive words of an item, or all words of a shorter one. Null or empty texts have no
    words: such documents have no hit, such items no window. Items of equal id count once, one of null id is
    named ''. Rows of equal id are judged each by its text. An empty table of items leaves all documents clean."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = lambda df, i, t: df.select(F.col(i).alias("id"), F.coalesce(F.col(t), F.lit("")).alias("text"))
    named = text(items, item_id, item_text).withColumn("id", F.coalesce(F.col("id").cast("string"), F.lit("")))
    parts = checkpointed(named.mapInArrow(_item_windows(window, k), "id string, size int, windows array<string>, prints array<bigint>"))
    short = [r.size for r in parts.filter(F.col("size") < window).select("size").distinct().collect()]  # fewer than `window`
    pages, bits = _print_filter(parts.select(F.explode("prints").alias("print")).distinct())
    shared = spark.sparkContext.broadcast(pages)

    def hits(batches):
        yield from _doc_hits(window, k, short, shared.value, bits)(batches)

    rows = text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    read = checkpointed(rows.mapInArrow(hits, f"id {rows.schema['id'].dataType.simpleString()}, tie bigint, n_words bigint, hits array<struct<start:int,size:int,window:string>>"))
    there = read.filter(F.size("hits") > 0).select("id", "tie", F.explode("hits").alias("h")).select("id", "tie", "h.*")
    known = parts.select(F.explode(F.array_distinct("windows")).alias("window"), F.col("id").alias("item")).distinct()
    met = there.join(known, "window").groupBy("id", "tie").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    met = met.withColumn("n_hit", F.expr("aggregate(spans, named_struct('to', 0, 'n', 0L), (a, s) -> named_struct('to', greatest(a.to, s.end), 'n', a.n + greatest(0, s.end - greatest(a.to, s.start))), a -> a.n)"))
    met = met.select(F.col("id").alias("i"), F.col("tie").alias("t"), "n_hit", "items")
    out = read.select("id", "tie", "n_words").join(met, F.col("id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), listed.alias("items"), "tie")
