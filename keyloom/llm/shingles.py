"""The sets of word shingles of texts, as hashes, and what a similarity join of such sets needs of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import WORD_BASES, flat_bytes, fmix, slices, span_hashes, window_hashes, word_spans
from .sketch import Magnitudes, Repeated

#: 64-bit words of a set's fingerprint, and smallest shingles that travel beside it.
FP_WORDS, LEADS = 4, 4
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Shingles:
    """The different shingles (hashes, ascending in each row) of a slice of rows: row and gram of each, n and a
    hash of the set (node) of each row. A text of fewer words has one shingle, one without words has none."""

    def __init__(self, batch, words: int):
        flat, offs = flat_bytes(batch.column("text"))
        starts, ends, first = word_spans(_LOWER[flat], offs, ~_SPACE)
        hashes, count = span_hashes(_LOWER[flat], starts, ends), np.diff(first)
        rows, grams = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
        for size in range(1, words + 1):
            have = np.flatnonzero(count == size if size < words else count >= words)
            if len(have):
                n = count[have] - size + 1
                row = np.repeat(have, n)
                rows.append(row)
                grams.append(window_hashes(hashes, size, WORD_BASES[0])[np.arange(len(row)) + np.repeat(first[have] - (np.cumsum(n) - n), n)])
        row, gram = np.concatenate(rows), np.concatenate(grams)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        self.row, self.gram = row[new], gram[new]
        self.n = np.bincount(self.row, minlength=len(count))
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        total = np.concatenate([np.zeros(1, _U), np.cumsum(fmix(self.gram + _U(WORD_BASES[1])), dtype=_U)])
        self.node = np.where(self.n > 0, fmix(total[self.first[1:]] - total[self.first[:-1]] + self.n.astype(_U)), _U(0)).view(np.int64)

    def ordered(self, often: Magnitudes) -> np.ndarray:
        """Keys of the shingles, ascending in each row: how often a shingle occurs (a magnitude), then most of its
        hash. Any order that all rows share makes prefixes meet; this one keeps common passages out of them."""
        key = (often(self.gram).astype(_U) << _U(57)) | (self.gram >> _U(7))
        return key[np.lexsort((key, self.row))]

    def prefix(self, similarity: float) -> np.ndarray:
        """Places of the ordered shingles in the rows' prefixes: of two sets whose similarity is at least that, each
        has a shingle in its own prefix that is in the other's."""
        wide = self.n - np.ceil(similarity * self.n - 1e-9).astype(np.int64) + 1
        return np.flatnonzero(np.arange(len(self.gram)) - np.repeat(self.first[:-1], self.n) < np.repeat(wide, self.n))

    def fingerprint(self, row: int) -> list[int]:
        """SimHash of a row's set: a bit is 1 if it is set in over half of the shingles' hashes."""
        g = self.gram[self.first[row] : self.first[row + 1]]
        out = []
        for k in range(FP_WORDS):
            h, votes = fmix(g + _U((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF)), np.zeros(64, np.int64)
            for lo in range(0, len(h), 1 << 15):
                votes += np.unpackbits(h[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            out.append(int(np.packbits(2 * votes > len(h), bitorder="little").view("<i8")[0]))
        return out


def shingle_bits(text_bytes: int) -> int:
    """Bits of a sketch of how often shingles occur: a counter for some 256 words, 2**24 (32 MB in all) at most. With
    more words than that, only passages in ever more texts stand out."""
    return min(24, max(16, (text_bytes // (6 * 256)).bit_length()))


def all_keys(words: int):
    """Arrays of the shingles of whole sets."""

    def run(batches):
        for b in slices(batches, "text"):
            yield Shingles(b, words).gram

    return run


def set_nodes(words: int, pages, bits: int):
    """(id, tie, node, n, f0, f1, ..., l0, l1, ...) of every row: equal sets have equal nodes, sizes n, fingerprints
    and first shingles in their order (the last one repeated where there are fewer, 0 without any)."""

    def run(batches):
        often = Magnitudes(pages.value, bits)
        for b in slices(batches, "text"):
            s = Shingles(b, words)
            fps = np.array([s.fingerprint(r) for r in range(len(s.n))], np.int64).reshape(-1, FP_WORDS)
            grams = np.concatenate([s.ordered(often), np.zeros(1, _U)]).view(np.int64)
            leads = [np.where(s.n > 0, grams[s.first[:-1] + np.clip(s.n - 1, 0, k)], 0) for k in range(LEADS)]
            columns = [s.node, s.n, *[fps[:, k] for k in range(FP_WORDS)], *leads]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tie"), *map(pa.array, columns)], names=["id", "tie", "node", "n", *[f"f{k}" for k in range(FP_WORDS)], *[f"l{k}" for k in range(LEADS)]])

    return run


def prefix_keys(words: int, similarity: float, pages, bits: int):
    """Arrays of the ordered shingles in prefixes."""

    def run(batches):
        often = Magnitudes(pages.value, bits)
        for b in slices(batches, "text"):
            s = Shingles(b, words)
            yield s.ordered(often)[s.prefix(similarity)]

    return run


def prefix_rows(words: int, similarity: float, pages, bits: int, repeats):
    """(gram, node): a row an ordered shingle of a prefix that the sketch has as repeated."""

    def run(batches):
        often, repeated = Magnitudes(pages.value, bits), Repeated(repeats.value)
        for b in slices(batches, "text"):
            s = Shingles(b, words)
            at, gram = s.prefix(similarity), s.ordered(often)
            at = at[repeated(gram[at])]
            yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int64)), pa.array(s.node[s.row[at]])], names=["gram", "node"])

    return run


def twice(batches):
    """The nodes of a table, so that a sketch has each of them as a repeated one."""
    for b in batches:
        yield np.repeat(b.column("node").to_numpy().view(_U), 2)


def whole_sets(words: int, pages):
    """The whole sets of the texts whose nodes are in the sketch; a task gives each node once."""

    def run(batches):
        wanted, given = Repeated(pages.value), set()
        for b in slices(batches, "text"):
            s = Shingles(b, words)
            rows = np.flatnonzero(wanted(s.node.view(_U)))
            rows = np.array([r for r in rows.tolist() if not (s.node[r] in given or given.add(s.node[r]))], np.int64)
            raw = [s.gram[s.first[r] : s.first[r + 1]].tobytes() for r in rows.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(s.node[rows]), pa.array(raw, pa.binary())], names=["node", "grams"])

    return run


def similar_sets(similarity: float):
    """The pairs whose sets are similar enough."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run
