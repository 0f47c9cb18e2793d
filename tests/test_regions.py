"""Streams with keyed state: commits matched with prewrites, region clocks, the frontier."""

from collections import defaultdict
from random import Random

import pytest
from keyloom.streaming import frontier, regions

SCHEMA = "region_id bigint, kind string, key binary, start_ts bigint, crts bigint, op_type int, value binary, old_value binary, sequence bigint"


def event(sequence, kind, key=None, start=None, crts=None, value=None, old=None, region=1):
    b = lambda x: None if x is None else bytearray(x.encode())
    return (region, kind, b(key), start, crts, 1, b(value), b(old), sequence)


class Feed:
    """A folder of files that a stream reads, one append a batch, and a query that can be stopped and goes on."""

    def __init__(self, spark, path, schema, made):
        self.spark, self.path, self.schema, self.made = spark, path, schema, made

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def run(self):
        self.spark.conf.set("spark.sql.shuffle.partitions", "2")
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")
        query = self.made(stream).writeStream.format("parquet").option("path", f"{self.path}/out").option("checkpointLocation", f"{self.path}/progress").trigger(availableNow=True).start()
        query.awaitTermination()

    def rows(self):
        return self.spark.read.parquet(f"{self.path}/out").collect()


def text(x):
    return None if x is None else bytes(x).decode()


CASES = [
    # a rollback takes the prewrite away, and so a commit has none; another commit has its values, and takes them
    ([event(1, "initialized"), event(2, "prewrite", "k1", 1, None, "v1", "v2"), event(3, "prewrite", "k1", 2, None, "v3", "v4"), event(4, "rollback", "k1", 1), event(5, "commit", "k1", 1, 3), event(6, "commit", "k1", 2, 4)],
     [(5, None, None, regions.NO_PREWRITE), (6, "v3", "v4", None)]),
    # an empty prewrite is a sign of life only
    ([event(1, "initialized"), event(2, "prewrite", "k1", 1, None, "v1", "v2"), event(3, "prewrite", "k1", 1, None, None, "v4"), event(4, "commit", "k1", 1, 2), event(5, "commit", "k1", 1, 2)],
     [(4, "v1", "v2", None), (5, None, None, regions.NO_PREWRITE)]),
    # commits wait until the history is read; those without a prewrite are left out then
    ([event(1, "commit", "k1", 1, 2), event(2, "commit", "k2", 3, 4), event(3, "commit", "k3", 4, 5), event(4, "prewrite", "k1", 1, None, "v1", "ov1"), event(5, "prewrite", "k2", 3, None, "v2", "ov2"), event(6, "prewrite", "k2", 4, None, "v3", "ov3"),
      event(7, "initialized"), event(8, "initialized"), event(9, "commit", "k2", 4, 9)],
     [(1, "v1", "ov1", None), (2, "v2", "ov2", None), (9, "v3", "ov3", None)]),
    # markers before the history do not count; entries at or below a resolved timestamp are errors
    ([event(1, "resolved", crts=50), event(2, "committed", "k1", None, 40, "old"), event(3, "initialized"), event(4, "resolved", crts=10), event(5, "resolved", crts=8), event(6, "prewrite", "k1", 9, None, "v"),
      event(7, "commit", "k1", 9, 10), event(8, "commit", "k1", 9, 11), event(9, "committed", "k2", None, 10, "w")],
     [(2, "old", None, None), (7, None, None, regions.BEHIND), (8, "v", None, None), (9, "w", None, regions.BEHIND)]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_commits_of_a_stream(spark, tmp_path, case):
    rows, want = CASES[case]
    feed = Feed(spark, tmp_path, SCHEMA, lambda s: regions.match_commits(s, parts=2))
    for part in (rows[:3], rows[3:]):
        feed.put(part[::-1])  # within a batch any order will do
        feed.run()  # and goes on from its state
    assert sorted((r.sequence, text(r.value), text(r.old_value), r.error) for r in feed.rows()) == want


def test_an_unknown_kind_stops_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA, regions.match_commits)
    feed.put([event(1, "other", "k")])
    with pytest.raises(Exception, match="unknown kind"):
        feed.run()


def plain_matches(rows):
    open_, waiting, ready, out = defaultdict(dict), defaultdict(list), set(), []
    for region, kind, key, start, crts, _, value, old, seq in sorted(rows, key=lambda r: r[-1]):
        name = (start, key and bytes(key))
        if kind == "prewrite" and (name not in open_[region] or value):
            open_[region][name] = (value, old)
        elif kind == "rollback":
            open_[region].pop(name, None)
        elif kind == "initialized":
            ready.add(region)
            for s, n, v in waiting.pop(region, []):
                if n in open_[region]:
                    out.append((s, region, text(open_[region].pop(n)[0]), None))
        elif kind == "commit":
            if name in open_[region]:
                out.append((seq, region, text(open_[region].pop(name)[0]), None))
            elif region in ready:
                out.append((seq, region, None, regions.NO_PREWRITE))
            else:
                waiting[region].append((seq, name, crts))
    return sorted(out)


def test_many_commits(spark, tmp_path):
    random, rows = Random(4), []
    for seq in range(900):
        region, key, start = random.randrange(3), f"k{random.randrange(6)}", random.randrange(12)
        kind = random.choices(["prewrite", "commit", "rollback"], [5, 4, 1])[0]
        if seq in (300, 450, 600):
            rows.append(event(seq, "initialized", region=(seq - 300) // 150))
        else:
            rows.append(event(seq, kind, key, start, 1000 + seq, random.choice(["", f"v{seq}"]) if kind == "prewrite" else None, None, region))
    feed = Feed(spark, tmp_path, SCHEMA, lambda s: regions.match_commits(s, parts=3, forget=3_600_000))
    for at in (0, 450):
        feed.put(rows[at : at + 450])
    feed.run()
    assert sorted((r.sequence, r.region_id, text(r.value), r.error) for r in feed.rows()) == plain_matches(rows)


def test_clocks(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA, regions.region_clocks)
    marks = [("resolved", 5), ("initialized", None), ("resolved", 4), ("resolved", 9), ("resolved", 7), ("resolved", 9), ("prewrite", None), ("resolved", 12)]
    rows = [event(k, kind, "k" if kind == "prewrite" else None, 1, ts, region=r) for r in (1, 2) for k, (kind, ts) in enumerate(marks)]
    feed.put([r for r in rows if r[-1] < 4])
    feed.run()
    feed.put([r for r in rows if r[-1] >= 4])
    feed.run()
    want = [(2, 4, 1, 0), (3, 9, 1, 0), (5, 9, 1, 1), (7, 12, 1, 1)]
    assert sorted((r.region_id, r.sequence, r.resolved_ts, r.ignored, r.regressed) for r in feed.rows()) == [(region, *w) for region in (1, 2) for w in want]


MARKS = [("a", "d", 5), ("d", "e", 100), ("g", "h", 200), ("a", "d", 1), ("a", "d", 2), ("a", "d", 1), ("b", "c", 3), ("b", "c", 4), ("a", "d", 3), ("a", "b", 5), ("c", "d", 5), ("b", "c", 5), ("a", "d", 6), ("a", "c", 7), ("b", "d", 8), ("a", "b", 8), ("1", "g", 9), ("g", "i", 10)]
LOWS = [5, 5, 5, 1, 2, 1, 1, 1, 3, 3, 3, 5, 6, 6, 7, 8, 9, 9]


def test_intervals():
    ranges = frontier.IntervalMap()
    for (s, e, ts), low in zip(MARKS, LOWS, strict=True):
        ranges.set(s.encode(), e.encode(), ts)
        assert ranges.low() == low
    random, plain, ranges = Random(9), {}, frontier.IntervalMap()
    for k in range(400):
        s, e = random.randrange(30), random.choice([None, *range(31, 40), *range(1, 31)])
        if e is not None and e <= s:
            continue
        ranges.set(bytes([s]), None if e is None else bytes([e]), k % 17)
        plain.update(dict.fromkeys(range(s, 41 if e is None else e), k % 17))
        assert ranges.low() == min(plain.values())
        assert {x: next(t for b, (e, t) in ranges.at.items() if b <= bytes([x]) and (e is None or bytes([x]) < e)) for x in plain} == plain
        assert ranges.starts == sorted(ranges.at)


@pytest.mark.parametrize("cuts", [[], [b"b", b"d", b"g"]])
def test_frontier_of_a_stream(spark, tmp_path, cuts):
    feed = Feed(spark, tmp_path, "feed string, start binary, end binary, resolved_ts bigint, arrival bigint", lambda s: frontier.frontier_stream(s, cuts))
    rows = [("f", bytearray(s.encode()), bytearray(e.encode()), t, i) for i, (s, e, t) in enumerate(MARKS)]
    for at, to in ((0, 8), (8, 18)):
        feed.put(rows[at:to])
        feed.run()
    got = sorted((r.arrival, r.frontier, r.emitted) for r in feed.rows())
    assert got == [(7, 1, 1), (17, 9, 9)]
