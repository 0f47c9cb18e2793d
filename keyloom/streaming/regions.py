"""Keyed state of a change feed's regions: commits matched with their prewrites, and resolved timestamps.

A feed's events have columns region_id, kind, key, start_ts, crts, op_type, value, old_value and sequence (the
order of arrival). Kinds are prewrite, commit, rollback, committed (an entry that needs no match), initialized
(the region's history has been read) and resolved (crts holds the timestamp; neither has a key)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from keyloom.functions import timestamps as T
from keyloom.streaming.ordered import RowProcessor, by_key, in_order

#: Of events that every part of a region must see.
MARKERS = ("initialized", "resolved")
_EVENT = "start_ts bigint, crts bigint, op_type int, key binary, sequence bigint"
MATCHED = "region_id bigint, op_type int, key binary, value binary, old_value binary, start_ts bigint, crts bigint, sequence bigint, error string"
ADVANCED = "region_id bigint, resolved_ts bigint, sequence bigint, ignored bigint, regressed bigint"
NO_PREWRITE, BEHIND = "commit without a prewrite", "commit at or below the resolved timestamp"


def keyed_state(spark: SparkSession) -> None:
    """Keep streaming state in the store that arbitrary keyed state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Reads of single entries after which the state's names are looked through, and how many names a read is worth.
READS, NAMES = 256, 16


class _Overlay:
    """A map in the state store behind what this batch has done to it: an entry is written only if the batch leaves it
    changed, so that prewrites and commits of one batch never reach the store. After some reads the names of what is
    stored are learnt, unless these are far more than the reads were; then only entries that are there are read."""

    def __init__(self, state):
        self.state, self.read, self.now = state, {}, {}
        self.reads, self.next, self.stored = 0, READS, None

    def _held(self, key):
        if self.stored is None:
            self.reads += 1
            if self.reads == self.next:
                self._learn()
        if self.stored is not None and hash(key) not in self.stored:
            return None
        return self.state.getValue(key) if self.state.containsKey(key) else None

    def _learn(self) -> None:
        self.next, stored = self.reads * 4, set()
        for n, (start_ts, key) in enumerate(self.state.keys() if self.state.exists() else ()):
            if n == self.reads * NAMES:
                return
            stored.add(hash((start_ts, bytes(key))))
        self.stored = stored

    def get(self, key):
        if key in self.now:
            return self.now[key]
        held = self._held(key)
        if held is not None:
            self.read[key] = self.now[key] = held
        return held

    def put(self, key, value) -> None:
        self.get(key)
        if value is None and key not in self.read:
            self.now.pop(key, None)
        else:
            self.now[key] = value

    def write(self) -> None:
        for key, value in self.now.items():
            if value != self.read.get(key):
                self.state.removeKey(key) if value is None else self.state.updateValue(key, value)


class CommitMatcher(RowProcessor):
    """Per part of a region: open prewrites by start timestamp and key, commits that wait for the region's history,
    and whether it has been read. Open prewrites are forgotten after `forget` milliseconds, by the state store."""

    def __init__(self, forget: int | None = None):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "start_ts bigint, key binary", "value binary, old_value binary", self.forget)
        self.waiting = handle.getListState("waiting", _EVENT)
        self.region = handle.getValueState("region", "ready boolean, resolved_ts bigint")

    def handleRows(self, key, rows) -> Iterator[tuple]:
        region = key[0]
        ready, resolved = self.region.get() if self.region.exists() else (False, 0)
        prewrites, waiting, before = _Overlay(self.open), [], (ready, resolved)

        def entry(r, value, old, error=None):
            return region, r.op_type, r.key, value, old, r.start_ts, r.crts, r.sequence, error

        def matched(r):
            name = (r.start_ts, bytes(r.key))
            held = prewrites.get(name)
            if held is None:
                return None
            prewrites.put(name, None)
            return entry(r, *held)

        for r in in_order(rows, "sequence"):
            if r.kind == "prewrite":
                name, held = (r.start_ts, bytes(r.key)), prewrites.get((r.start_ts, bytes(r.key)))
                if held is None or r.value:  # an empty one is only a sign that its transaction lives
                    prewrites.put(name, (r.value, r.old_value))
            elif r.kind == "rollback":
                prewrites.put((r.start_ts, bytes(r.key)), None)
            elif r.kind == "initialized":
                ready = True
                held = [Row(start_ts=w[0], crts=w[1], op_type=w[2], key=w[3], sequence=w[4]) for w in self.waiting.get()] if self.waiting.exists() else []
                self.waiting.clear()
                # a waiting commit that still has no prewrite came with the history already
                yield from (m for m in map(matched, [*held, *waiting]) if m is not None)
                waiting = []
            elif r.kind == "resolved":
                if ready and r.crts > resolved:
                    resolved = r.crts
            elif r.kind == "committed":
                yield entry(r, r.value, r.old_value, BEHIND if ready and r.crts <= resolved else None)
            elif r.kind == "commit":
                if ready and r.crts <= resolved:
                    yield entry(r, None, None, BEHIND)
                    continue
                found = matched(r)
                if found is not None:
                    yield found
                elif ready:
                    yield entry(r, None, None, NO_PREWRITE)
                else:
                    waiting.append(r)
            else:
                raise ValueError(f"unknown kind {r.kind!r} of event {r.sequence} of region {region}")
        prewrites.write()
        if waiting:
            self.waiting.appendList([(r.start_ts, r.crts, r.op_type, bytes(r.key), r.sequence) for r in waiting])
        if (ready, resolved) != before:
            self.region.update((ready, resolved))


def match_commits(events: DataFrame, parts: int = 8, forget: int | None = None) -> DataFrame:
    """The entries of a streaming feed: commits with the values of their prewrites, and committed entries as they are.

    A prewrite without a value does not replace one before it, a rollback removes it, and a commit takes it away.
    Commits that come before their region's history has been read wait until then, and are left out if there is
    still no prewrite. After that a commit without one is a row with an error, and so is an entry at or below the
    region's resolved timestamp; neither stops the stream. A region's keys are dealt to so many parts, each with a
    state of its own, so that a busy region is not one task; its markers go to all of them. Events of one region must
    come in the order of their sequence from batch to batch; within a batch any order will do."""
    spark = events.sparkSession
    keyed_state(spark)
    if forget:  # else a trigger that ends with its input never does: the clock alone asks for one more batch
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    marker = F.col("kind").isin(*MARKERS)
    part = F.when(marker, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")))
    dealt = events.withColumn("part", F.explode(part))
    return by_key(dealt, ["region_id", "part"], CommitMatcher(forget), MATCHED, "processingTime" if forget else "none")


class RegionClock(RowProcessor):
    """Per region: whether its history has been read, its resolved timestamp, and how many marks did not count."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.region = handle.getValueState("region", "ready boolean, resolved_ts bigint, ignored bigint, regressed bigint")

    def handleRows(self, key, rows) -> Iterator[tuple]:
        ready, resolved, ignored, regressed = self.region.get() if self.region.exists() else (False, None, 0, 0)
        for r in in_order(rows, "sequence"):
            if r.kind == "initialized":
                ready = True
            elif r.kind != "resolved":
                continue
            elif not ready:
                ignored += 1
            elif resolved is not None and r.crts < resolved:
                regressed += 1
            else:
                resolved = r.crts
                yield key[0], resolved, r.sequence, ignored, regressed
        self.region.update((ready, resolved, ignored, regressed))


def region_clocks(events: DataFrame, safe_ms: int = 0) -> DataFrame:
    """The marks of a streaming feed that move a region's resolved timestamp, moved back by a safe interval: those
    before the region's history has been read are ignored, those below an earlier one are dropped, and both are
    counted. One number a region is kept."""
    keyed_state(events.sparkSession)
    marks = events.filter(F.col("kind").isin(*MARKERS)).select("region_id", "kind", (T.moved_back("crts", safe_ms) if safe_ms else F.col("crts")).alias("crts"), "sequence")
    return by_key(marks, ["region_id"], RegionClock(), ADVANCED)
