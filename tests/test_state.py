"""The state table, and ordered release."""

from keyloom.operators import changelog
from keyloom.streaming import apply, release

from .test_logs import STEPS
from .test_regions import Feed

LOG = "op_type int, key string, value string, crts bigint, sequence bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG)


def shown(df):
    return {(r.key, r.value) for r in df.collect()}


def test_a_batch_writes_the_buckets_that_it_touches(spark, tmp_path):
    table = apply.StateTable(f"file://{tmp_path}/t", buckets=16, compact_after=3, keep=2)
    rows, want = [], {}
    for k in range(400):
        rows.append((1, f"k{k}", f"v{k}", k, k))
        want[f"k{k}"] = f"v{k}"
    table.merge(frame(spark, rows), 0)
    assert shown(table.state(spark)) == set(want.items())
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / "t/data" / name).rglob("*.parquet"))
    whole = size("delta-00000000")
    for epoch in range(1, 6):
        batch = [(1 if epoch != 3 else 2, "k7", f"new{epoch}", 1000 + epoch, 1000 + epoch), (3, None, None, 2000, 2000)]
        table.merge(frame(spark, batch), epoch)
        table.merge(frame(spark, batch), epoch)  # a re-run changes nothing
        want["k7"] = f"new{epoch}"
        assert shown(table.state(spark)) == {x for x in want.items() if epoch != 3 or x[0] != "k7"}
        made = f"{'base' if epoch == 3 else 'delta'}-{epoch:08d}"  # the third delta of a bucket makes a base of it
        assert len([p for p in (tmp_path / "t/data" / made).iterdir() if p.name.startswith("state_bucket=")]) == 1
        assert size(made) < whole / 5
    m = table.manifest(spark, 5)["buckets"]
    assert sorted({n for names in m.values() for n in names}) == ["base-00000003", "delta-00000000", "delta-00000004", "delta-00000005"]
    assert table.versions(spark) == [4, 5] and table.version(spark, 1) is None
    assert {p.name for p in (tmp_path / "t/data").iterdir()} == {"base-00000003", "delta-00000000", "delta-00000004", "delta-00000005"}
    assert shown(table.state(spark, 4)) == {(k, v if k != "k7" else "new4") for k, v in want.items()}
    table.merge(frame(spark, []), 6)
    assert shown(table.state(spark)) == set(want.items())


def test_ordered_release_in_steps(spark, tmp_path):
    schema = "keyspan_id bigint, crts bigint, op_type int, key binary, value binary, sequence bigint"
    feed, n, want = Feed(spark, tmp_path, schema, lambda s: release.ordered_release(s, width=2)), 0, []
    for entries, resolved, out in STEPS:
        rows = []
        for key, ts, op in [*entries, (None, resolved, changelog.RESOLVED)]:
            rows.append((1, ts, op, None if key is None else bytearray(key.encode()), None, n))
            n += 1
        feed.put(rows)
        want += [*out, (None, resolved)]
    feed.run()
    got = sorted(feed.rows(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(len(want)))
    assert [(None if r.key is None else bytes(r.key).decode(), r.crts) for r in got] == want
