"""Summaries of batch units and of streams; hashes of values of very different lengths."""

import time

import numpy as np
import pandas as pd
import pytest
from keyloom.functions import hashes
from keyloom.plans import summary
from pyspark.sql import functions as F


def test_units(spark, tmp_path):
    s = summary.RunSummary()
    rows = s.counted(spark.range(100), "write", F.col("id") * 2)
    with s.unit("write"):
        rows.write.parquet(f"{tmp_path}/x")
    with s.unit("nothing"):
        pass
    with pytest.raises(Exception, match="exists"), s.unit("again"):
        spark.range(1).write.parquet(f"{tmp_path}/x")
    got = {r.unit: (r.ok, r.rows, r.bytes) for r in s.table(spark).collect()}
    assert got == {"write": (True, 100, 9900), "nothing": (True, 0, 0), "again": (False, 0, 0)}
    t = s.totals(spark).first()
    assert (t.succeeded, t.failed, t.rows, t.bytes) == (2, 1, 100, 9900) and t.seconds > 0 and t.bytes_a_second > 0
    assert summary.RunSummary().totals(spark).first().succeeded == 0


def test_streams(spark, tmp_path):
    s = summary.StreamSummary(spark)
    try:
        spark.range(70).write.parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/in")
        for name, df in (("good", stream), ("bad", stream.select(F.raise_error(F.lit("no"))))):
            query = df.writeStream.format("noop").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
            if name == "good":
                query.awaitTermination()
            else:
                with pytest.raises(Exception, match="no"):
                    query.awaitTermination()
        end = time.time() + 30
        while time.time() < end and not (s.totals.get("good", {}).get("rows") == 70 and s.totals.get("bad", {}).get("failed")):
            time.sleep(0.2)
        got = {r["query"]: r for r in s.report().collect()}
        assert got["good"].rows == 70 and got["good"].failed == 0 and got["good"].rows_a_second > 0 and got["bad"].failed == 1
        assert {r["query"]: r.rows_a_second for r in s.report().collect()}["good"] == 0
    finally:
        s.close()


def test_hashes_do_not_widen_to_the_longest_value(monkeypatch):
    random = np.random.default_rng(1)
    values = pd.Series([random.bytes(int(n)) for n in random.integers(0, 40, 200)] + [None, random.bytes(3000), random.bytes(700)])
    for kernel in (hashes.crc64_values, hashes.murmur3_values, hashes.murmur3_64_values):
        want, widest = kernel(values), []
        monkeypatch.setattr(hashes, "AREA", 2000)

        def spied(part, kernel=kernel, widest=widest):
            widest.append(len(part) * max(0 if v is None else len(v) for v in part))
            return kernel(part)

        assert (hashes.by_length(spied, values) == want).all()
        assert sorted(widest)[-2:] == [700, 3000] or max(w for w in widest if w not in (700, 3000)) <= 2000
        assert len(hashes.by_length(kernel, pd.Series([], dtype=object))) == 0
        monkeypatch.undo()
