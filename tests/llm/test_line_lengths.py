"""Exact repeats of short lines, and lines that share their segments with many others."""

import numpy as np
import pytest
from keyloom.llm import line_dedup, queries
from pyspark.sql import functions as F

from . import plain
from .test_operators import DOCS, ONCE, SF, rows_of, same, table


def repeats(rows):
    """Places of the non-empty lines that an equal line comes before, of rows with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        out[i] = set()
        for p, line in enumerate((t or "").split("\n")):
            if line and line in seen:
                out[i].add(p)
            seen.add(line)
    return out


def test_lines_of_every_length_are_compared(spark):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(table(spark, ONCE)).collect()}
    exact, near = repeats(ONCE), {i: {int(p) for p in x.split(",") if p} for i, *_, x in plain.repeated_lines(ONCE)}
    assert {i: set(r.removed) for i, r in got.items()} == {i: exact[i] | near[i] for i, _ in ONCE}
    assert {i: (r.n_exact, r.n_near) for i, r in got.items()} == {i: (len(exact[i]), len(near[i] - exact[i])) for i, _ in ONCE}


def test_op7_reports_every_exact_repeat(spark):
    want = repeats(DOCS)
    got = {r.doc_id: r for r in queries.op7_line_dedup(spark, SF).collect()}
    assert {i: r.n_exact for i, r in got.items()} == {i: len(x) for i, x in want.items()}
    assert all(want[i] <= {int(p) for p in r.removed.split(",") if p} for i, r in got.items())


@pytest.mark.parametrize(("few", "finest", "edits"), [(0, (2, 8, 1 << 30), line_dedup.EDITS), (2, (32, 1 << 30), ((5, 1), (14, 2), (30, 3)))])
def test_lines_under_crowded_keys_meet_by_rare_pieces(spark, monkeypatch, few, finest, edits):
    monkeypatch.setattr(line_dedup, "LEADERS", (1,))
    monkeypatch.setattr(line_dedup, "FEW", few)
    monkeypatch.setattr(line_dedup, "FINEST", finest)
    rng = np.random.default_rng(8)
    some = lambda n, letters: "".join(rng.choice(list(letters), n))
    made = []
    for k in range(60):
        base = "Notice of " + some(int(rng.integers(0, 16)), "abcdefgh") if k % 3 else "aaaaaaaaaaaa" + some(int(rng.integers(0, 9)), "ab\u00e9")
        made.append(base)
        for _ in range(3):
            x = list(base)
            for _ in range(int(rng.integers(1, 5))):
                p = int(rng.integers(0, len(x)))
                x[p : p + int(rng.integers(0, 2))] = [some(1, "abz")] * int(rng.integers(0, 2))
            made.append("".join(x))
    rows = [(int(i), made[k]) for k, i in enumerate(rng.permutation(len(made)))]
    got = line_dedup.dedup_lines(table(spark, rows), edits=edits).withColumn("removed", F.array_join("removed", ","))
    allowed = lambda n: max((e for low, e in edits if n >= low), default=0)
    same(rows_of(got, "doc_id", "n_lines", "n_exact", "n_near", "removed"), plain.repeated_lines(rows, allowed))
