"""Conversation operators against plain versions that look at every prefix and every edit."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import product

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from keyloom.llm import conversation_repair, conversation_trie, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLE = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
#: Nulls, empty and blank texts, repeated rows, ties, gaps, ids below zero, absent first conversations.
ROWS = [
    (0, 0, "system", "Be brief."), (0, 1, "user", "Hi."), (0, 2, "assistant", "Hello!"), (0, 4, "user", "no end"), (1, None, "user", "first"), (1, 0, None, "x."), (1, 3, "user", None), (1, 3, "user", "tie."),
    (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (2, 1, "assistant", ""), (3, 5, "", " \t\n"), (4, 0, "assistant", "A."), (4, 1, "assistant", "B."), (4, 2, "assistant", "A."), (7, 0, "user", "alone in its family."),
    (13, 0, "tool", "Grüße?"), (-3, 0, "user", "below zero."), (-3, 1, "assistant", "yes."), (None, 0, "user", "no id."), (None, 1, "assistant", "no id"), (9, None, None, None), (9, None, None, None),
    *[(20 + k, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if t < 6 else f"own {k} {t}.") for k in range(24) for t in range(4 + k % 6)],
    *[(100 + k, t, "user", "same.") for k in range(12) for t in range(3)], (200, 0, "user", "long. " * 20000), *[(300, t, "user", f"step {t % 7}.") for t in range(200)],
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    own = {c: [v[3:] for v in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def plain_trie(rows):
    made = rebuilt(rows)
    members, out = defaultdict(list), []
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    below, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node in members:
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += kids[node] == 0
    for node, have in members.items():
        ends = ",".join(str(c) for c in have if len(made[c]) == len(node))
        out.append((have[0], len(node), members[node[:-1]][0] if node else None, len(have), kids[node], leaves[node], saved[node], sha(ends)))
    return out


def trie_rows(df):
    return sorted((tuple(r) for r in df.select(*conversation_trie._COLUMNS, "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("local", [1, 3, 256])
def test_trie(spark, local):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3).select(*[F.lit(1).alias(c) for c in ("base", "syms", "path", "n", "bucket", "level", "digest")], "*")
    assert trie_rows(conversation_trie.conversation_trie(df, local)) == sorted(plain_trie(ROWS), key=repr)


def test_trie_of_tables(spark):
    assert trie_rows(queries.op11_conversation_trie(spark, SF)) == sorted(plain_trie(TABLE), key=repr)
    empty = conversation_trie.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    same = [(5 * k, 0, "user", "x") for k in range(40)]
    assert trie_rows(conversation_trie.conversation_trie(spark.createDataFrame(same, SCHEMA))) == sorted(plain_trie(same), key=repr)
    none = [(1, 0, "user", "x")]  # crc32("1") % 9 turns come from conversation 0, which is absent
    assert trie_rows(conversation_trie.conversation_trie(spark.createDataFrame(none, SCHEMA))) == sorted(plain_trie(none), key=repr)


def test_packed_members(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PACK", 7)
    rows = [(b"a", k) for k in range(50)] + [(b"b", 3), (b"c", -5), (b"c", 10), (b"c", 9)]
    got = conversation_trie.ends(spark.createDataFrame(rows, "path binary, conv_id bigint").repartition(5)).collect()
    assert {bytes(r.path): r.ends_sha256 for r in got} == {b"a": sha(",".join(map(str, range(50)))), b"b": sha("3"), b"c": sha("-5,9,10")}


def damage(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        out[c] += [(t is not None, t or 0, "user" if fault == 4 else r, x)] * {0: 0, 3: 2}.get(fault, 1)
    return {c: [(t if have else None, r, x) for have, t, r, x in sorted(v)] for c, v in out.items()}


def facts(rows):
    seen, faults = set(), []
    for _, r, x in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", x)
        faults.append("b" if not shown else "d" if (r, x) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((r, x))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return faults, (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal)


def plain_repair(rows):
    """Least cost first, by growing all edit sequences; returns the least (cost, audit, rows)."""
    faults, counted = facts(rows)
    best = None
    for letters in product("DKR", repeat=len(rows)):
        if any(f in ("b", "d") and l != "D" for f, l in zip(faults, letters, strict=True)):
            continue
        base = sum({"D": 4, "K": 0, "R": 3}[l] + (3 if f == "t" and l != "D" else 0) for f, l in zip(faults, letters, strict=True))
        for inserts in product(range(3), repeat=len(rows) + 1):
            cost = base + 3 * sum(inserts)
            if best is not None and cost > best[0]:
                continue
            audit = "".join("I" * k + l for k, l in zip(inserts, [*letters, ""], strict=True))
            at, out, ok = 0, [], True
            for edit in audit:
                want = "assistant" if out and out[-1][0][:1] == "u" else "user"
                if edit == "I":
                    out.append((want, ""))
                    continue
                _, role, text = rows[at]
                at += 1
                if edit != "D":
                    out.append((want if edit == "R" else role, text))
            ok = re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)) is not None
            if ok and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return *counted, best[0], best[1], sha("\n".join(f"{r}:{x}" for r, x in best[2]))


def repaired(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select(*[F.lit(1).alias(c) for c in ("fault", "copy", "times", "here")], "*")
    got = conversation_repair.repair_conversations(conversation_repair.damaged(df)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def one(rows, settle=None):
    r = conversation_repair._Repair()
    for row in rows:
        r.add(*row)
    return r.result()


def test_repair_of_short_conversations(spark):
    got, want = repaired(spark, ROWS), damage(ROWS)
    assert got.keys() == {r[0] for r in ROWS}
    for c, rows in want.items():
        if len(rows) <= 4:
            assert got[c] == plain_repair(rows), (c, rows)
    for c in got.keys() - {c for c, rows in want.items() if rows}:
        assert got[c] == (0, 0, 0, 0, 0, 0, "", sha(""))


def stepwise(rows):
    """Least (cost, audit) by a search over whole strings: states and all their strings of least cost."""
    faults, counted = facts(rows)
    keep = {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    def closed(states):
        states = dict(states)
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                if follow[s] not in states or (c + 3, a + "I") < states[follow[s]]:
                    states[follow[s]] = (c + 3, a + "I")
        return states

    states = closed({"": (0, "")})
    for f, (_, role, _) in zip(faults, rows, strict=True):
        made = {}
        for s, (c, a) in states.items():
            options = [(s, 4, "D")]
            if f not in ("b", "d"):
                extra = 3 if f == "t" else 0
                options.append((follow[s], 3 + extra, "R"))
                if (role[:1], s) in keep:
                    options.append((keep[role[:1], s], extra, "K"))
            for to, cost, letter in options:
                made[to] = min(made.get(to, (1 << 60, "")), (c + cost, a + letter))
        states = closed(made)
    return *counted, *min(states[s] for s in ("", "a") if s in states)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b.", "c", "d", " ", "e!"])), max_size=4))
def test_repair_against_all_edits(rows):
    rows = [(k, r, x) for k, (r, x) in enumerate(rows)]
    assert one(rows) == plain_repair(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "user", "assistant", "system"]), st.sampled_from(["x.", "y"]), st.booleans()), max_size=60), st.integers(1, 9))
def test_repair_of_long_conversations(rows, settle):
    rows = [(k, r, f"{k if new else 0}{x}") for k, (r, x, new) in enumerate(rows)]
    before, conversation_repair.SETTLE = conversation_repair.SETTLE, settle
    try:
        assert one(rows)[:7] == stepwise(rows)
    finally:
        conversation_repair.SETTLE = before


def test_repair_of_tables(spark):
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SF).collect()}
    want = damage(TABLE)
    assert got.keys() == want.keys()
    for c, rows in want.items():
        assert got[c][:7] == stepwise(rows)
        if len(rows) <= 4:
            assert got[c] == plain_repair(rows)
    assert repaired(spark, [(1, 0, "user", None)])[1][7] == sha("")
    assert conversation_repair.repair_conversations(conversation_repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
