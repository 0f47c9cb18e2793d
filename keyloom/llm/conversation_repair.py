"""Operator 13: conversation structure repair by a forward Viterbi pass over a grammar of turns.

A repaired conversation's role initials read `(s?(ua)+)?`: an optional system turn, then user and assistant in
turn. Rows go by conversation to tasks that read them sorted, one after another. For each of the grammar's four
states (nothing yet, after the system turn, after a user, after an assistant) the pass carries the least
(cost, audit string) of the edits so far; each row's layer is closed with the turns that may be inserted there."""

from __future__ import annotations

import hashlib
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: States of the grammar.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of edits, and of a truncated turn that stays.
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Layers after which the edits that all states agree on are settled.
SETTLE = 64
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_ENDS = frozenset(".!?")
_PAIRS = frozenset(("su", "ua", "au"))

RESULT = "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, here): the rows with the damage that a checksum of `conv_id:turn` picks. Nulls
    count as one space. A dropped row stays with here = false and a blank text, so that its conversation is known."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("fault"))
    hit = lambda n: F.col("fault") == n
    made = rows.select(
        "conv_id", "turn", F.when(hit(4), "user").otherwise(F.col("role")).alias("role"),
        F.when(hit(0), " ").when(hit(1), "").when(hit(2), F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (~hit(0)).alias("here"), F.when(hit(3), 2).otherwise(1).alias("times"),
    )
    return made.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "copy")


class _Repair:
    """One conversation's rows, taken in order."""

    def __init__(self):
        self.low = self.high = self.last_turn = self.last_initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
        self.layer, self.audit, self.state = 0, [], START
        self.waiting: deque = deque()
        self.digest, self.first = hashlib.sha256(), True
        self._close()

    def _close(self) -> None:
        """Turns inserted after the layer: at most two lead from any state to any other that they can lead to."""
        for state in (START, SYSTEM, USER, ASSISTANT):
            if self.best[state] is not None:
                self._offer(self.best, _NEXT[state], self.best[state], INSERT, "I")

    @staticmethod
    def _offer(best, state, path, cost, letter) -> None:
        total, have = path[0] + cost, best[state]
        if have is None or total < have[0] or (total == have[0] and path[1] + letter < have[1]):
            best[state] = (total, path[1] + letter)

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += (self.last_initial + initial) not in _PAIRS
        self.last_initial = initial
        name = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        shown = _VISIBLE.search(text) is not None
        again = name in self.seen
        self.seen.add(name)
        cut = False
        if not shown:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in _ENDS:
            self.truncated += 1
            cut = True
        stays, extra = shown and not again, TRUNCATED if cut else 0
        made: list[tuple[int, str] | None] = [None] * 4
        for state, path in enumerate(self.best):
            if path is None:
                continue
            self._offer(made, state, path, DELETE, "D")
            if stays:
                self._offer(made, _NEXT[state], path, REROLE + extra, "R")
                to = _KEPT.get((initial, state))
                if to is not None:
                    self._offer(made, to, path, extra, "K")
        self.best = made
        self._close()
        # whatever repairs the rest from the start does so after an assistant with at most one more deletion, and
        # after a system turn with none: a state further behind than that is on no cheapest path
        behind = self.best[ASSISTANT]
        if behind is not None:
            for state, slack in ((START, DELETE), (SYSTEM, 0)):
                if self.best[state] is not None and self.best[state][0] > behind[0] + slack:
                    self.best[state] = None
        self.waiting.append((role, text))
        self.layer += 1
        if self.layer % SETTLE == 0:
            self._settle()

    def _settle(self, letters: str | None = None) -> None:
        """Write out the edits that all paths begin with, or the given ones."""
        if letters is None:
            paths = [p[1] for p in self.best if p is not None]
            a, b = min(paths), max(paths)
            n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            letters = a[:n]
            self.best = [p if p is None else (p[0], p[1][n:]) for p in self.best]
        self.audit.append(letters)
        for edit in letters:
            role, text = ("", "") if edit == "I" else self.waiting.popleft()
            if edit == "D":
                continue
            self.state = _KEPT[role[:1], self.state] if edit == "K" else _NEXT[self.state]
            self.digest.update((("" if self.first else "\n") + f"{role if edit == 'K' else _ROLE[self.state]}:{text}").encode())
            self.first = False

    def result(self) -> tuple:
        cost, letters = min(p for p in (self.best[START], self.best[ASSISTANT]) if p is not None)
        self._settle(letters)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.digest.hexdigest()


def _repaired(batches):
    """Results of the conversations whose rows come one after another; one conversation is held at a time."""
    now, repair, out = None, None, []
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def made():
        rows = list(zip(*out, strict=True))
        ids = pa.array(rows[0], kind)
        return pa.RecordBatch.from_arrays([ids, *[pa.array(r, pa.int64() if k < 6 else pa.string()) for k, r in enumerate(rows[1:])]], names=names)

    kind = None
    for b in batches:
        kind = b.schema.field("conv_id").type
        for conv, turn, role, text, here in zip(*[b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "here")], strict=True):
            if repair is None or conv != now:
                if repair is not None:
                    out.append((now, *repair.result()))
                now, repair = conv, _Repair()
            if here:
                repair.add(turn, role, text)
        if len(out) >= 1000:
            yield made()
            out = []
    if repair is not None:
        out.append((now, *repair.result()))
        yield made()


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """A row a conv_id: the faults of its rows in the order of their turns, the least cost of edits that give the
    grammar, their audit string (K, R, D of each row, I between rows; of equal costs the least in ASCII order) and
    the SHA-256 of the repaired rows. The rows have columns conv_id, turn, role, text and here (whether the row
    is there); others are left out. No column but conv_id and turn may be null.

    Null turns come first; rows of one turn are ordered by role and text. Rows with a null id are one conversation
    with a null id. A conversation without a row that is here has zeros, an empty audit and the hash of nothing; an
    empty table gives an empty result. A row is a fault's first kind only: blank, seen before, truncated.

    One conversation is one task's sequence: a hash of 16 bytes a row is held to know repeats, and the rows since
    the last edit that all paths share. Texts of any length are one string each."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text", "here")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(_repaired, RESULT.format(id=kind))
