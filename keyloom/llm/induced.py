"""External induced sorting of suffixes, with their common prefixes.

The suffixes that start where the text turns from falling to rising are sorted first: their stretches up to
the next such place are named by rank, and where names repeat, the string of names is sorted the same way,
recursively. They then induce the falling suffixes in ascending order and these the rising ones in descending
order. Both passes run over a queue with a priority for each first symbol; what waits in it is written to disk
beyond a memory limit. Suffix tuples carry the common prefix with their predecessor: one more than the
smallest one passed since the last tuple that went to the same symbol."""

from __future__ import annotations

import tempfile
from collections import defaultdict
from pathlib import Path

import numpy as np

#: Bytes of waiting tuples that a queue holds in memory.
MEMORY = 64 << 20
#: Alphabets up to this size are induced a bucket at a time by numpy, larger ones a suffix at a time.
SMALL = 1024


class BulkQueue:
    """Tuples by symbol, first in first out within a symbol; rows of int64, `width` numbers each."""

    def __init__(self, folder: Path, width: int, memory: int = MEMORY):
        self.file = tempfile.TemporaryFile(dir=folder)
        self.width, self.memory, self.held = width, memory, 0
        self.parts: dict[int, list] = defaultdict(list)

    def push(self, symbol: int, *columns: np.ndarray) -> None:
        rows = np.stack(columns, 1)
        self.parts[symbol].append(rows)
        self.held += rows.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file.seek(0, 2)
        for parts in self.parts.values():
            for i, rows in enumerate(parts):
                if isinstance(rows, np.ndarray):
                    parts[i] = (self.file.tell(), len(rows))
                    self.file.write(rows.tobytes())
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        """All rows that wait for the symbol, oldest first."""
        out = []
        for rows in self.parts.pop(symbol, []):
            if isinstance(rows, tuple):
                self.file.seek(rows[0])
                rows = np.frombuffer(self.file.read(8 * self.width * rows[1]), np.int64).reshape(-1, self.width)
            else:
                self.held -= rows.nbytes
            out.append(rows)
        return np.concatenate(out) if out else np.zeros((0, self.width), np.int64)

    def close(self) -> None:
        self.file.close()


class ListQueue:
    """Suffixes by symbol, first in first out within a symbol, for large alphabets: lists are appended to
    directly, and pushed() then says by how many."""

    def __init__(self, folder: Path, memory: int = MEMORY):
        self.file, self.memory, self.held = tempfile.TemporaryFile(dir=folder), memory, 0
        self.lists: dict[int, list[int]] = defaultdict(list)
        self.spilled: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def pushed(self, n: int) -> None:
        self.held += 40 * n
        if self.held > self.memory:
            self.file.seek(0, 2)
            for symbol, values in self.lists.items():
                self.spilled[symbol].append((self.file.tell(), len(values)))
                self.file.write(np.array(values, np.int64).tobytes())
            self.lists.clear()
            self.held = 0

    def pop(self, symbol: int) -> list[int]:
        own = self.lists.pop(symbol, [])
        self.held = max(0, self.held - 40 * len(own))
        if symbol not in self.spilled:
            return own
        out = []
        for at, n in self.spilled.pop(symbol):
            self.file.seek(at)
            out += np.frombuffer(self.file.read(8 * n), np.int64).tolist()
        return out + own


def rising(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is larger than the empty suffix."""
    n = len(t)
    turn = np.empty(n, np.int8)
    turn[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1].astype(np.int64))
    turn[-1] = -1
    where = np.where(turn != 0, np.arange(n), n)
    return turn[np.minimum.accumulate(where[::-1])[::-1]] > 0


def _names(t: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of each stretch from one start to the next, both symbols included; equal stretches, equal ranks. A
    stretch that continues another's symbols is the smaller, as it goes on falling."""
    n, m = len(t), len(start)
    top = int(t.max()) + 3
    bits = top.bit_length()
    step = 63 // bits
    end = np.concatenate([start[1:] + 1, [n + 1]])  # the last one takes in the empty suffix, below every symbol
    text = np.concatenate([t.astype(np.int64) + 1, [0]])
    name, live, r = np.zeros(m, np.int64), np.arange(m), 0
    while len(live):
        key = np.zeros(len(live), np.int64)
        for k in range(r, r + step):
            at = start[live] + k
            key = (key << bits) | np.where(at < end[live], text[np.minimum(at, n)], top)
        order = np.lexsort((key, name[live]))
        live, key = live[order], key[order]
        old = name[live]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        sub = group | np.concatenate([[True], key[1:] != key[:-1]])
        index = np.arange(len(live))
        first = np.maximum.accumulate(np.where(group, index, 0))
        lead = np.maximum.accumulate(np.where(sub, index, 0))
        name[live] = old + lead - first
        size = np.diff(np.concatenate([np.flatnonzero(sub), [len(live)]]))
        r += step
        live = live[(np.repeat(size, size) > 1) & (start[live] + r < end[live])]
    return name


def _eights(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first one lowest (zeros beyond the end)."""
    wide = np.zeros(len(t) + 8, np.uint8)
    wide[: len(t)] = t
    out = wide[: len(t)].astype(np.uint64)
    for k in range(1, 8):
        out |= wide[k : k + len(t)].astype(np.uint64) << np.uint64(8 * k)
    return out


def _common(eights: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the different suffixes at a and b, at most cap; eight bytes are compared at a time."""
    n = len(eights)
    out = np.minimum(cap, n - np.maximum(a, b))
    live = np.arange(len(a))
    for k in range(0, cap, 8):
        live = live[out[live] > k]
        if not len(live):
            break
        apart = eights[a[live] + k] ^ eights[b[live] + k]
        end = np.flatnonzero(apart)
        low = apart[end] & (~apart[end] + np.uint64(1))  # the lowest bit that differs
        same = (np.frexp(low.astype(np.float64))[1] - 1) >> 3
        out[live[end]] = np.minimum(out[live[end]], k + same)
        live = live[apart == 0]
    return out


def _turns(t: np.ndarray, up: np.ndarray, folder: Path, memory: int) -> np.ndarray:
    """The suffixes at which the text turns to rising, sorted."""
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    if len(lms) < 2:
        return lms
    name = _names(t, lms)
    values, dense = np.unique(name, return_inverse=True)
    return lms[np.argsort(name)] if len(values) == len(lms) else lms[_order(dense.astype(np.int64), folder, memory)]


def _order(t: np.ndarray, folder: Path, memory: int) -> np.ndarray:
    """Suffixes of a string of names, sorted (no common prefixes)."""
    up = rising(t)
    seeds = _turns(t, up, folder, memory)
    if int(t.max()) < SMALL:
        parts = [np.concatenate([low, high]) for low, _, high, _ in Induction(t, up, seeds, folder, memory, 0).buckets()]
        return np.concatenate(parts[::-1])
    text = t.tolist()
    before = [-1, *text[:-1]]  # the symbol before each place
    falls, rises = [False, *(~up[:-1]).tolist()], [False, *up[:-1].tolist()]  # what the suffix before each place does
    by_symbol: dict[int, list[int]] = defaultdict(list)
    for p in seeds.tolist():
        by_symbol[text[p]].append(p)
    present = np.unique(t).tolist()
    falling: dict[int, list[int]] = {}
    queue = ListQueue(folder, memory)
    queue.lists[text[-1]].append(len(t) - 1)
    for c in present:
        batch, lists = queue.pop(c), queue.lists
        for p in batch:  # grows while it is read
            if falls[p]:
                s = before[p]
                if s == c:
                    batch.append(p - 1)
                else:
                    lists[s].append(p - 1)
        falling[c] = batch
        own = by_symbol.get(c, ())
        for p in own:
            lists[before[p]].append(p - 1)
        queue.pushed(len(batch) + len(own))
    out = []
    for c in present[::-1]:
        batch, lists = queue.pop(c), queue.lists
        down = falling.pop(c)[::-1]
        for source in (batch, down):
            for p in source:
                if rises[p]:
                    s = before[p]
                    if s == c:
                        batch.append(p - 1)
                    else:
                        lists[s].append(p - 1)
        queue.pushed(len(batch) + len(down))
        out += [batch, down]
    queue.file.close()
    return np.array([p for part in out for p in part], np.int64)[::-1]


class Induction:
    """Both inducing passes over a text of few symbols."""

    def __init__(self, t: np.ndarray, up: np.ndarray, seeds: np.ndarray, folder: Path, memory: int, cap: int):
        self.t, self.up, self.seeds, self.folder, self.memory, self.cap = t, up, seeds, folder, memory, cap
        self.symbols = int(t.max()) + 1
        self.eights = _eights(t) if cap else None

    def _send(self, queue, pos, lcp, passed, want_up, c):
        """Queue the predecessors of a batch (all are of the wanted kind); those of symbol c come back."""
        prev = pos - 1
        ok = prev >= 0
        ok[ok] = self.up[prev[ok]] == want_up
        at = np.flatnonzero(ok)
        prev = prev[at]
        sym = self.t[prev].astype(np.int64)
        order = np.argsort(sym, kind="stable")
        at, prev, sym = at[order], prev[order], sym[order]
        lead = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]])) if len(sym) else np.zeros(0, np.int64)
        own = np.zeros(len(at), np.int64)
        if self.cap:
            low = np.minimum.accumulate(lcp)
            own[lead] = np.minimum(passed[sym[lead]], low[at[lead]])
            rest = np.ones(len(at), bool)
            rest[lead] = False
            r = np.flatnonzero(rest)
            own[r] = _range_min(lcp, at[r - 1] + 1, at[r] + 1)
            own = np.minimum(own + 1, self.cap)
            np.minimum(passed, low[-1], out=passed)
            after = np.minimum.accumulate(lcp[::-1])[::-1]
            last = np.concatenate([lead[1:] - 1, [len(at) - 1]]) if len(lead) else lead
            passed[sym[last]] = np.where(at[last] + 1 < len(lcp), after[np.minimum(at[last] + 1, len(lcp) - 1)], self.cap)
        same = None
        for a, b in zip(lead.tolist(), [*lead[1:].tolist(), len(at)], strict=False):
            if sym[a] == c:
                same = (prev[a:b], own[a:b])
            else:
                queue.push(int(sym[a]), prev[a:b], own[a:b])
        return same

    def _rounds(self, queue, c, passed, want_up):
        """The bucket's suffixes of the wanted kind: those that wait, then those that they induce themselves."""
        rows = queue.pop(c)
        batch, out = (rows[:, 0], rows[:, 1]), []
        while batch is not None and len(batch[0]):
            out.append(batch)
            batch = self._send(queue, *batch, passed, want_up, c)
        empty = np.zeros(0, np.int64)
        return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])) if out else (empty, empty)

    def _meet(self, a: int, b: int) -> int:
        return int(_common(self.eights, np.array([a]), np.array([b]), self.cap)[0]) if self.cap else 0

    def buckets(self):
        """By first symbol, descending: the falling suffixes and the rising ones, each ascending with the common
        prefixes with their predecessors (at most cap; all 0 if cap is 0)."""
        t, n = self.t, len(self.t)
        seed_sym = t[self.seeds]
        bounds = np.searchsorted(seed_sym, np.arange(self.symbols + 1))
        present = np.flatnonzero(np.bincount(t, minlength=self.symbols)).tolist()
        queue, kept = BulkQueue(self.folder, 2, self.memory), BulkQueue(self.folder, 2, self.memory)
        passed = np.full(self.symbols, -1, np.int64)
        queue.push(int(t[-1]), np.array([n - 1]), np.array([0]))  # induced by the empty suffix
        passed[t[-1]] = self.cap
        for c in present:
            pos, lcp = self._rounds(queue, c, passed, False)
            if len(pos):
                kept.push(c, pos, lcp)
            seeds = self.seeds[bounds[c] : bounds[c + 1]]
            if len(seeds):
                own = np.zeros(len(seeds), np.int64)
                if self.cap:
                    own[1:] = _common(self.eights, seeds[:-1], seeds[1:], self.cap)
                    own[0] = self._meet(int(pos[-1]), int(seeds[0])) if len(pos) else 0
                self._send(queue, seeds, own, passed, False, -1)
        queue.close()
        queue, passed = BulkQueue(self.folder, 2, self.memory), np.full(self.symbols, -1, np.int64)
        for c in present[::-1]:
            high, down = self._rounds(queue, c, passed, True)  # descending, common prefixes with the one above
            rows = kept.pop(c)
            low, lcp = rows[:, 0], rows[:, 1]
            meet = self._meet(int(low[-1]), int(high[-1])) if len(low) and len(high) else 0
            if len(low):
                self._send(queue, low[::-1], np.concatenate([[meet], lcp[:0:-1]]), passed, True, -1)
            yield low, lcp, high[::-1], np.concatenate([[meet], down[:0:-1]]) if len(high) else high
        queue.close()
        kept.close()


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest of values[low:high] for each pair (low < high)."""
    if not len(low):
        return np.zeros(0, np.int64)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.int64)
    table = values
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def suffix_buckets(t: np.ndarray, cap: int, folder: Path, memory: int = MEMORY):
    """Sorted suffixes of t (small non-negative integers; may be a memory map) with common prefixes up to cap,
    bucket by bucket as Induction.buckets yields them."""
    if len(t):
        up = rising(t)
        yield from Induction(t, up, _turns(t, up, folder, memory), folder, memory, cap).buckets()


def repeated_starts(t: np.ndarray, length: int, folder: Path, memory: int = MEMORY):
    """Arrays of the places at which a string of `length` symbols starts that starts elsewhere too."""
    for low, lcp_low, high, lcp_high in suffix_buckets(t, length, folder, memory):
        pos, lcp = np.concatenate([low, high]), np.concatenate([lcp_low, lcp_high])
        long = lcp >= length
        long[:-1] |= lcp[1:] >= length
        if long.any():
            yield pos[long]
