"""Summaries of runs: units of work that ended or failed, what they handled and how long they took."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

UNITS = "unit string, ok boolean, seconds double, rows bigint, bytes bigint, error string"


class RunSummary:
    """Units of a run, a row each. What they handle is counted by the jobs that handle it, without a job of its own."""

    def __init__(self):
        self.units: list[tuple] = []
        self.counts: dict[str, Observation] = {}

    def counted(self, df: DataFrame, unit: str, size: Column | None = None) -> DataFrame:
        """The same rows; the action that reads them counts them, and adds up their sizes, for a unit."""
        self.counts[unit] = Observation(unit)
        return df.observe(self.counts[unit], F.count("*").alias("rows"), F.coalesce(F.sum(size) if size is not None else F.lit(None), F.lit(0)).cast("bigint").alias("bytes"))

    @contextmanager
    def unit(self, name: str) -> Iterator[None]:
        """A unit of work; one that fails is noted and its error goes on."""
        began = time.monotonic()
        try:
            yield
        except Exception as e:
            self.units.append((name, False, time.monotonic() - began, 0, 0, f"{type(e).__name__}: {e}"[:500]))
            raise
        found = self.counts[name].get if name in self.counts else {"rows": 0, "bytes": 0}
        self.units.append((name, True, time.monotonic() - began, found["rows"], found["bytes"], None))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.units, UNITS)

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row: units that ended and failed, rows, bytes, seconds, and bytes a second of those that ended."""
        ok = F.col("ok")
        sums = [F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in ("rows", "bytes", "seconds")]
        out = self.table(spark).agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), *sums)
        return out.withColumn("bytes_a_second", F.when(F.col("seconds") > 0, F.col("bytes") / F.col("seconds")))


class StreamSummary(StreamingQueryListener):
    """Totals of the streaming queries of a session by name: batches, rows, seconds, and the rate since the last report.
    A few numbers a query are held, however long it runs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.totals, self.names = spark, {}, {}
        spark.streams.addListener(self)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        t = self.totals.setdefault(p.name or str(p.id), {"batches": 0, "rows": 0, "seconds": 0.0, "since": time.monotonic(), "fresh": 0, "failed": 0})
        t["batches"] += 1
        t["rows"] += p.numInputRows
        t["fresh"] += p.numInputRows
        t["seconds"] += p.durationMs.get("triggerExecution", 0) / 1000

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            t = self.totals.setdefault(self.names.get(str(event.id), str(event.id)), {"batches": 0, "rows": 0, "seconds": 0.0, "since": time.monotonic(), "fresh": 0, "failed": 0})
            t["failed"] += 1

    def report(self) -> DataFrame:
        """(query, batches, rows, seconds, failed, rows_a_second): the rate is that since the last report."""
        now, rows = time.monotonic(), []
        for name, t in sorted(self.totals.items()):
            passed = now - t["since"]
            rows.append((name, t["batches"], t["rows"], t["seconds"], t["failed"], t["fresh"] / passed if passed > 0 else None))
            t["since"], t["fresh"] = now, 0
        return self.spark.createDataFrame(rows, "query string, batches bigint, rows bigint, seconds double, failed bigint, rows_a_second double")
