"""Plain, quadratic versions of the training-data operators, and the rows that tests feed them."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

sha = lambda b: hashlib.sha256(b).hexdigest()

_PASSAGE = " ".join(f"passage{i}" for i in range(70))
_BYTES = "".join(chr(97 + (i * i + 7 * i) % 26) for i in range(350))
#: Nulls, empty and blank texts, ties, repeated rows, characters beyond ASCII, long words, special strings.
ROWS: list[tuple[int | None, str | None]] = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "Grüße <|endoftext|> an 数据 <|endoftext|>   x"),
    (7, f"before {_PASSAGE} after"), (8, f"other {_PASSAGE} words {_PASSAGE}"), (9, _PASSAGE), (9, _PASSAGE), (10, f"{_PASSAGE[:-3]} changed at its end"),
    (11, "a" * 3000), (12, "ab" * 900 + " tail"), (13, f"x{_BYTES}y{_BYTES}z"), (14, f"w{_BYTES[:230]}"), (15, "word " * 120), (16, "É" * 150 + "word " * 60), (None, _PASSAGE),
    (17, "The first line of this text is long enough\nshort\nThe second line of this text is long enough\nshort"), (18, "The first line of this text is long enough!\nThe sekond line of this text is long enough"),
    (19, "An unrelated line that nothing else resembles\n\n\nThe first line of that text is long enough"), (20, "don't they'll 12345 !!! \r\n\r\n  end  "), (21, "\x00\x01 control \x7f"), (22, "word " * 30000),
]
#: Names that operators might use for columns of their own.
CLASHES = ("id", "tie", "row", "key", "n", "spans", "start", "size", "line", "lines", "h", "g", "fp", "own", "kept", "least", "component", "hits")
ITEMS: list[tuple[str | None, str | None]] = [
    ("b1", " ".join(f"Passage{i}" for i in range(20, 45))), ("b2", "one"), ("b3", None), ("b4", ""), ("b5", "first line"), ("b5", "nothing else resembles"), ("b6", "word word word"),
    ("b7", "The first line of this text is long"), ("b8", "AN unrelated-line that nothing; else resembles the first line of that text is so long"),
]


def words_of(text: str | None, pattern: bytes) -> list[bytes]:
    return re.findall(pattern, (text or "").encode())


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def token_counts(rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        out.append((i, len((t or "").encode()), n, n > 1024))
    return out


def decontaminated(rows, items):
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = []
    for item, text in items:
        w = words_of(lowered(text), pattern)
        size = min(10, len(w))
        windows += [(item, w[a : a + size]) for a in range(len(w) - size + 1)] if w else []
    out = []
    for i, text in rows:
        w = words_of(lowered(text), pattern)
        hit, found = set(), set()
        for item, x in windows:
            for a in range(len(w) - len(x) + 1):
                if w[a : a + len(x)] == x:
                    hit |= set(range(a, a + len(x)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))).encode()), bool(hit)))
    return out


def without_windows(rows, window=50):
    split = [(i, words_of(t, rb"[^\x20\x09-\x0D]+")) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, w in split:
        for a in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[a : a + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - window + 1) if i is not None else ():
            if least[tuple(w[a : a + window])] < i:
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def without_bytes(rows, length=200):
    texts, count = [(i, (t or "").encode()) for i, t in rows], {}
    for _, t in texts:
        for a in range(len(t) - length + 1):
            count[t[a : a + length]] = count.get(t[a : a + length], 0) + 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if count[t[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        spans = len(re.findall(b"\1+", gone))
        out.append((i, len(t), sum(gone), spans, sha(bytes(x for x, g in zip(t, gone, strict=True) if not g))))
    return out


def simhashed(rows, radius=4):
    prints = []
    for _, t in rows:
        w = words_of(lowered(t), rb"[^\x20\x09-\x0D]+")
        shingles = [b" ".join(w[a : a + 4]) for a in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    groups: dict[int, list] = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    name = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, f"{prints[k]:016x}", name[find(k)]) for k, (i, _) in enumerate(rows)]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def repeated_lines(rows, allowed=lambda n: 0 if n < 10 else 1 if n < 20 else 2):
    """(id, lines, exact, near, places) of rows with distinct ids, none of them null. allowed: edits within which
    lines are near, by the characters of the longer one."""
    first: dict[str, tuple] = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for p, line in enumerate((t or "").split("\n")):
            if line:
                first.setdefault(line, (i, p))
    known = list(first)
    early = {x: any(first[y] < first[x] and abs(len(x) - len(y)) <= (n := allowed(max(len(x), len(y)))) and n and edits(x, y) <= n for y in known) for x in known}
    out = []
    for i, t in rows:
        exact, near = [], []
        for p, line in enumerate((t or "").split("\n")):
            if line in first and first[line] != (i, p):
                exact.append(p)
            elif line in first and early[line]:
                near.append(p)
        out.append((i, (t or "").count("\n") + 1, len(exact), len(near), ",".join(map(str, sorted(exact + near)))))
    return out


def token_digests(rows):
    """Of rows with distinct ids, none of them null."""
    tok, start, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


def byte_bpe(rows):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tok = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        ids = tok.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    return out


def media(rows):
    """(id, n_bytes, payload_bytes, payload_sha256, tail_crc32)."""
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        n = max(1, -(-len(raw) // 64)) * 64
        full = raw.ljust(n, b"\0")
        out.append((i, len(raw), n, sha(full), zlib.crc32(full[-64:])))
    return out
