"""The library's operators as queries over the driver's tables, with the SQL that says the same.

Events are a change log (see sources.logs.changes_of_events); nations and regions lay out key ranges; orders
and line items stand for files and pairs. Byte strings leave as text or hex."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import codec, hashes, timestamps, values
from keyloom.functions import keys as K
from keyloom.operators import changelog, checksums, folds, placement, ranges, watermarks
from keyloom.plans import backups, bulkload, feeds, manifests, restore, summary
from keyloom.sources import feed, logs
from keyloom.streaming import apply, frontier, regions, release, sinks
from keyloom.streaming.progress import plain_logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _log(spark: SparkSession, d: str) -> DataFrame:
    return logs.changes_of_events(_t(spark, d, "events"))


def _key(n):
    """Key of a number: u and eight digits."""
    n = F.expr(n) if isinstance(n, str) else n
    return F.encode(F.concat(F.lit("u"), F.lpad(n.cast("string"), 8, "0")), "UTF-8")


def _text(c: str):
    return F.decode(c, "UTF-8").alias(c)


def _shared(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share. Only local sessions may leave spark.checkpoint.dir out."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir")
    if not top and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    top = top or tempfile.gettempdir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CH = """WITH ch AS (SELECT CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS op_type, user_id,
  'u' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS key, event_type || ':' || CAST(event_id AS VARCHAR) AS value,
  epoch_us(ts) AS crts, event_id AS sequence, CAST(floor(value) AS BIGINT) + epoch_us(ts) // 1000000 AS expired_ts,
  event_type, event_id FROM events)"""
_K = "'u' || lpad(CAST({} AS VARCHAR), 8, '0')".format
_DAY = 86_400_000_000


# --- state of a log -----------------------------------------------------------------------------------------


@query(f"""{_CH}, last AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY crts DESC, sequence DESC) AS rn FROM ch
  WHERE crts <= (SELECT max(crts) - {_DAY} FROM ch))
SELECT key, value, crts, sequence FROM last WHERE rn = 1 AND op_type = 1""")
def kv_current_state(spark, d):
    log = _log(spark, d)
    bound = F.broadcast(log.agg((F.max("crts") - _DAY).alias("resolved")))  # one row
    state = changelog.current_state(log.crossJoin(bound), F.col("resolved"))
    return state.select(_text("key"), _text("value"), "crts", "sequence")


@query(f"""{_CH} SELECT event_id, op_type FROM ch WHERE starts_with(key, 'u000000')
  AND regexp_matches(key, '[3-9]$') AND (op_type = 2 OR regexp_matches(value, '^(view|click):[0-9]*[02468]$'))""")
def kv_filter_prefix_regex(spark, d):
    log = _log(spark, d).withColumn("key", K.encode_v2("key"))
    return log.filter(changelog.kv_filter("u00000\\x30", "[3-9]$", "^(view|click):[0-9]*[02468]$")).select("event_id", "op_type")


@query(f"{_CH} SELECT key, count(*) AS n, max(crts) AS last_ts FROM ch WHERE key >= 'u00000010' AND key < 'u00000050' GROUP BY key")
def key_span_scan(spark, d):
    log = _log(spark, d).filter(K.in_span("key", F.lit(b"u00000010"), F.lit(b"u00000050")))
    return log.groupBy("key").agg(F.count("*").alias("n"), F.max("crts").alias("last_ts")).select(_text("key"), "n", "last_ts")


def _spans(spark, d, width: int, step: int = 6):
    nation = _t(spark, d, "nation")
    return nation.select(F.col("n_nationkey").alias("region_id"), _key(f"n_nationkey * {step}").alias("start"), _key(f"n_nationkey * {step} + {width}").alias("end"))


_SP = "sp AS (SELECT n_nationkey AS region_id, {a} AS \"start\", {b} AS \"end\" FROM nation)".format


@query(f"""{_CH}, {_SP(a=_K('n_nationkey * 6'), b=_K('n_nationkey * 6 + 3'))}
SELECT event_id, key FROM ch WHERE EXISTS (SELECT 1 FROM sp WHERE key >= "start" AND key < "end")""")
def key_in_any_span(spark, d):
    return ranges.in_any(_log(spark, d), _spans(spark, d, 3)).select("event_id", _text("key"))


@query(f"{_CH} SELECT DISTINCT key, '72000000' || hex(encode(key)) AS v2, key AS back FROM ch")
def v2_key_roundtrip(spark, d):
    keys = _log(spark, d).select("key").distinct().withColumn("code", K.encode_v2("key"))
    return keys.select(_text("key"), F.hex("code").alias("v2"), F.decode(K.decode_v2("code"), "UTF-8").alias("back"))


@query(f"{_CH} SELECT DISTINCT key, key AS back FROM ch")
def memcomparable_roundtrip(spark, d):
    keys = _log(spark, d).select("key").distinct().withColumn("code", K.encode_memcomparable("key"))
    return keys.select(_text("key"), F.decode(K.decode_memcomparable("code"), "UTF-8").alias("back"))


@query(f"""{_CH}, w AS (SELECT *, op_type = 1 AND expired_ts > 0 AND expired_ts <= 1704672000 AS gone FROM ch)
SELECT event_id, CASE WHEN gone THEN 2 ELSE op_type END AS op, CASE WHEN op_type = 1 AND NOT gone AND expired_ts > 0 THEN expired_ts - 1704672000 ELSE 0 END AS ttl,
  CASE WHEN op_type = 1 AND NOT gone THEN value END AS value FROM w""")
def ttl_to_delete(spark, d):
    log = _log(spark, d).withColumn("key", K.encode_v2("key"))
    return changelog.as_writes(log, 1_704_672_000).select("event_id", "op", F.col("ttl").cast("bigint").alias("ttl"), _text("value"))


@query(f"{_CH} SELECT min(key) AS low, max(key) AS high, count(*) AS n FROM ch")
def key_min_max(spark, d):
    return _log(spark, d).agg(F.decode(F.min("key"), "UTF-8").alias("low"), F.decode(F.max("key"), "UTF-8").alias("high"), F.count("*").alias("n"))


@query(f"{_CH} SELECT CAST(ceil(avg(length(key) + length(value))) AS BIGINT) AS bytes FROM ch")
def pair_avg_size(spark, d):
    return _log(spark, d).agg(F.ceil(F.avg(K.approximate_size("key", "value"))).alias("bytes"))


@query(f"""{_CH} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY crts, sequence) AS place FROM ch""")
def ordered_event_log(spark, d):
    from pyspark.sql import Window

    return _log(spark, d).select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*changelog.event_order())).cast("bigint").alias("place"))


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM l WHERE rn = 1""")
def dedup_last_write(spark, d):
    items = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity").alias("written"))
    return changelog.last_write(items, "written", "l_orderkey", "l_linenumber").drop("written")


@query(f"""{_CH}, r AS (SELECT *, CASE WHEN op_type = lag(op_type) OVER (PARTITION BY user_id ORDER BY crts, sequence) THEN 0 ELSE 1 END AS new FROM ch),
  s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY crts, sequence) - 1 AS run FROM r)
SELECT user_id, CAST(run AS BIGINT) AS run, any_value(op_type) AS op_type, count(*) AS entries, CAST(sum(length(key) + length(value)) AS BIGINT) AS bytes, min(crts) AS first_ts, max(crts) AS last_ts FROM s GROUP BY user_id, run""")
def op_run_batches(spark, d):
    return changelog.write_batches(_log(spark, d), "op_type", "user_id")


@query(f"""{_CH}, s AS (SELECT *, max(expired_ts) OVER (PARTITION BY user_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_ts FROM ch)
SELECT event_id, expired_ts, seen_ts FROM s WHERE expired_ts < seen_ts""")
def ts_fallback(spark, d):
    return changelog.fallbacks(_log(spark, d), "user_id", "expired_ts").select("event_id", "expired_ts", "seen_ts")


@query(f"""{_CH}, m AS (SELECT *, CASE WHEN expired_ts > lag(expired_ts) OVER (PARTITION BY user_id ORDER BY sequence) THEN 1 WHEN lag(expired_ts) OVER (PARTITION BY user_id ORDER BY sequence) IS NULL THEN 1 ELSE 0 END AS moved FROM ch),
  r AS (SELECT *, sum(moved) OVER (PARTITION BY user_id ORDER BY sequence) AS run FROM m)
SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY sequence) - 1 AS BIGINT) AS penalty FROM r""")
def stuck_region_penalty(spark, d):
    marks = changelog.stuck_penalty(_log(spark, d), "user_id", "expired_ts", "sequence")
    return marks.select("event_id", F.col("penalty").cast("bigint").alias("penalty"))


@query("""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'),
  w AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS recent FROM e)
SELECT event_id, recent, recent >= 3 AS stop FROM w""")
def error_rate_window(spark, d):
    errors = _log(spark, d).filter("event_type = 'error'")
    return changelog.error_rate(errors, "crts", "user_id", 3, 24 * 60).select("event_id", "recent", "stop")


@query(f"{_CH} SELECT event_id FROM ch WHERE event_type = 'error' AND crts > 1704672000000000 - 86400000000")
def error_history_trim(spark, d):
    return changelog.trimmed_history(_log(spark, d).filter("event_type = 'error'"), "crts", 1_704_672_000_000_000, 24 * 60).select("event_id")


@query(f"""{_CH}, p AS (SELECT user_id, event_id % 4 AS partition, crts, event_id FROM ch), m AS (SELECT partition, max(crts) - 432000000000 * (partition + 1) AS own FROM p GROUP BY partition)
SELECT event_id, CAST(p.partition AS BIGINT) AS partition FROM p JOIN m USING (partition) WHERE crts > own AND crts > (SELECT min(own) FROM m)""")
def consumer_late_drop(spark, d):
    log = _log(spark, d).withColumn("partition", F.expr("event_id % 4"))
    marks = log.groupBy("partition").agg((F.max("crts") - F.lit(432_000_000_000) * (F.col("partition") + 1)).alias("resolved_ts"))
    return changelog.late_entries_dropped(log, marks).select("event_id", "partition")


@query("""WITH p AS (SELECT user_id, event_id, epoch_us(ts) // 86400000000 AS start_ts, CAST(event_id AS VARCHAR) AS v, value FROM events WHERE event_type = 'view'),
  best AS (SELECT user_id, start_ts, v, row_number() OVER (PARTITION BY user_id, start_ts ORDER BY (value >= 5)::INT DESC, event_id DESC) AS rn, value FROM p),
  c AS (SELECT user_id, event_id, epoch_us(ts) // 86400000000 AS start_ts FROM events WHERE event_type = 'purchase')
SELECT c.event_id, CASE WHEN value >= 5 THEN v ELSE '' END AS value FROM c JOIN best USING (user_id, start_ts) WHERE rn = 1""")
def matched_commits(spark, d):
    log = _t(spark, d, "events").withColumn("start_ts", F.expr(f"{logs._MICROS} div 86400000000")).withColumn("key", F.col("user_id"))
    pre = log.filter("event_type = 'view'").select("start_ts", "key", F.encode(F.when(F.col("value") >= 5, F.col("event_id").cast("string")).otherwise(""), "UTF-8").alias("value"), F.lit(None).cast("binary").alias("old_value"), F.col("event_id").alias("sequence"))
    commits = log.filter("event_type = 'purchase'").select("start_ts", "key", "event_id", F.lit(None).cast("binary").alias("value"), F.lit(None).cast("binary").alias("old_value"))
    return changelog.matched_commits(pre, commits).select("event_id", _text("value"))


# --- ranges -------------------------------------------------------------------------------------------------

_REG = f"reg AS (SELECT n_nationkey AS region_id, {_K('n_nationkey * 6')} AS \"start\", CASE WHEN n_nationkey < 24 THEN {_K('n_nationkey * 6 + 6')} END AS \"end\" FROM nation)"


def _regions(spark, d):
    return _t(spark, d, "nation").select(F.col("n_nationkey").alias("region_id"), _key("n_nationkey * 6").alias("start"), F.when(F.col("n_nationkey") < 24, _key("n_nationkey * 6 + 6")).alias("end"))


@query(f"""{_CH}, {_REG} SELECT region_id, count(*) AS n, count(DISTINCT key) AS keys FROM ch JOIN reg ON key >= "start" AND ("end" IS NULL OR key < "end") GROUP BY region_id""")
def region_lookup(spark, d):
    return ranges.locate(_log(spark, d), _regions(spark, d)).groupBy("region_id").agg(F.count("*").alias("n"), F.count_distinct("key").alias("keys"))


@query(f"""WITH {_REG}, k AS (SELECT DISTINCT {_K('s_suppkey')} AS key FROM supplier)
SELECT region_id, string_agg(key, ',' ORDER BY key) AS split_keys FROM k JOIN reg ON key > "start" AND ("end" IS NULL OR key < "end") GROUP BY region_id""")
def split_keys_by_region(spark, d):
    keys = _t(spark, d, "supplier").select(_key("s_suppkey").alias("key"))
    met = ranges.split_keys_by_range(keys, _regions(spark, d), "region_id")
    return met.select("region_id", F.array_join(F.transform("split_keys", lambda k: F.decode(k, "UTF-8")), ",").alias("split_keys"))


@query(f"""WITH {_REG}, b AS (SELECT r_regionkey, {_K('r_regionkey * 35 + 2')} AS s, CASE WHEN r_regionkey < 4 THEN {_K('r_regionkey * 35 + 30')} END AS e FROM region)
SELECT region_id, r_regionkey, greatest("start", s) AS "start", CASE WHEN "end" IS NULL THEN e WHEN e IS NULL THEN "end" ELSE least("end", e) END AS "end"
FROM reg JOIN b ON (e IS NULL OR "start" < e) AND ("end" IS NULL OR s < "end")""")
def span_intersection(spark, d):
    b = _t(spark, d, "region").select("r_regionkey", _key("r_regionkey * 35 + 2").alias("start"), F.when(F.col("r_regionkey") < 4, _key("r_regionkey * 35 + 30")).alias("end"))
    return ranges.intersect(_regions(spark, d), b).select("region_id", "r_regionkey", _text("start"), _text("end"))


@query(f"""WITH r AS (SELECT {_K('n_nationkey * 6')} AS s, {_K('n_nationkey * 6 + 1 + n_nationkey % 7')} AS e FROM nation),
  m AS (SELECT s, max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM r)
SELECT h AS "start", s AS "end" FROM m WHERE h < s UNION ALL SELECT max(e), NULL FROM r""")
def coverage_gaps(spark, d):
    have = _t(spark, d, "nation").select(_key("n_nationkey * 6").alias("start"), _key("n_nationkey * 6 + 1 + n_nationkey % 7").alias("end"))
    return ranges.gaps(have, b"u00000000").select(_text("start"), _text("end"))


@query(f"""WITH r AS (SELECT n_nationkey AS p, {_K('n_nationkey * 5')} AS s, {_K('n_nationkey * 5 + 12')} AS e FROM nation),
  pts AS (SELECT s AS x FROM r UNION SELECT e FROM r), pc AS (SELECT x, lead(x) OVER (ORDER BY x) AS y FROM pts)
SELECT x AS "start", y AS "end", string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS payloads FROM pc JOIN r ON x < e AND s < y GROUP BY x, y""")
def overlay_covering(spark, d):
    over = _t(spark, d, "nation").select("n_nationkey", _key("n_nationkey * 5").alias("start"), _key("n_nationkey * 5 + 12").alias("end"))
    return ranges.elementary(over, "n_nationkey").select(_text("start"), _text("end"), F.array_join(F.transform("payloads", lambda p: p.cast("string")), ",").alias("payloads"))


@query(f"""WITH r AS (SELECT n_nationkey AS p, {_K('(n_nationkey * 37) % 120')} AS s, {_K('(n_nationkey * 37) % 120 + 15')} AS e, CAST(n_nationkey * 11 % 40 AS BIGINT) AS ts FROM nation),
  pts AS (SELECT s AS x FROM r UNION SELECT e FROM r), pc AS (SELECT x, lead(x) OVER (ORDER BY x) AS y FROM pts),
  t AS (SELECT x, y, ts, row_number() OVER (PARTITION BY x, y ORDER BY p DESC) AS rn FROM pc JOIN r ON x < e AND s < y)
SELECT x AS "start", y AS "end", ts FROM t WHERE rn = 1""")
def step_function_set(spark, d):
    sets = _t(spark, d, "nation").select("n_nationkey", _key("(n_nationkey * 37) % 120").alias("start"), _key("(n_nationkey * 37) % 120 + 15").alias("end"), F.expr("cast(n_nationkey * 11 % 40 as bigint)").alias("ts"))
    return ranges.step_function(sets, "ts", "n_nationkey").select(_text("start"), _text("end"), "ts")


@query(f"""WITH r AS (SELECT n_nationkey AS p, {_K('(n_nationkey * 37) % 120')} AS s, {_K('(n_nationkey * 37) % 120 + 15')} AS e, n_nationkey * 11 % 40 AS ts FROM nation),
  pts AS (SELECT s AS x FROM r UNION SELECT e FROM r), pc AS (SELECT x, lead(x) OVER (ORDER BY x) AS y FROM pts),
  t AS (SELECT ts, row_number() OVER (PARTITION BY x, y ORDER BY p DESC) AS rn FROM pc JOIN r ON x < e AND s < y)
SELECT CAST(min(ts) AS BIGINT) AS frontier FROM t WHERE rn = 1""")
def span_frontier(spark, d):
    marks = _t(spark, d, "nation").select(_key("(n_nationkey * 37) % 120").alias("start"), _key("(n_nationkey * 37) % 120 + 15").alias("end"), F.expr("cast(n_nationkey * 11 % 40 as bigint)").alias("resolved_ts"), F.col("n_nationkey").alias("arrival"))
    return watermarks.span_frontier(marks)


@query(f"""WITH {_REG}, n AS (SELECT r_regionkey, {_K('r_regionkey * 40 + 3')} AS s, {_K('r_regionkey * 40 + 9')} AS e FROM region)
SELECT region_id, "start", "end" FROM reg WHERE NOT EXISTS (SELECT 1 FROM n WHERE "start" < e AND ("end" IS NULL OR s < "end")) UNION ALL SELECT 100 + r_regionkey, s, e FROM n""")
def range_overwrite(spark, d):
    new = _t(spark, d, "region").select((F.col("r_regionkey") + 100).alias("region_id"), _key("r_regionkey * 40 + 3").alias("start"), _key("r_regionkey * 40 + 9").alias("end"))
    return ranges.overwrite(_regions(spark, d), new).select("region_id", _text("start"), _text("end"))


@query(f"""WITH {_REG}, c AS (SELECT *, coalesce("start" = lag("end") OVER (ORDER BY "start"), row_number() OVER (ORDER BY "start") = 1) AS ok FROM reg)
SELECT min("start") <= 'u00000000' AND bool_and(ok) AND bool_or("end" IS NULL) AS contiguous FROM c""")
def region_contiguity(spark, d):
    return ranges.contiguity(_regions(spark, d), b"u00000000", None)


@query(f"""{_CH}, f AS (SELECT DISTINCT key FROM ch) SELECT key, CASE WHEN starts_with(key, 'u0000001') THEN 'new1' || key[9:] WHEN starts_with(key, 'u000000') THEN 'old' || key[8:] ELSE key END AS renamed FROM f""")
def prefix_rewrite(spark, d):
    keys = _log(spark, d).select("key").distinct().withColumn("renamed", F.col("key"))
    rules = spark.createDataFrame([(1, bytearray(b"u0000001"), bytearray(b"new1")), (2, bytearray(b"u000000"), bytearray(b"old"))], "rule_no int, old_prefix binary, new_prefix binary")
    return backups.rewritten(keys, rules, "renamed").select(_text("key"), _text("renamed"))


# --- workers, feeds, watermarks -----------------------------------------------------------------------------

_ASSIGN = "sp AS (SELECT s_suppkey AS keyspan_id, CASE WHEN s_suppkey % 10 < 5 THEN 0 WHEN s_suppkey % 10 < 8 THEN 1 ELSE 2 END AS capture_id, s_nationkey FROM supplier), cap AS (SELECT CAST(r_regionkey AS INTEGER) AS capture_id FROM region)"


def _assigned(spark, d):
    return _t(spark, d, "supplier").select(F.col("s_suppkey").alias("keyspan_id"), F.expr("case when s_suppkey % 10 < 5 then 0 when s_suppkey % 10 < 8 then 1 else 2 end").alias("capture_id"), "s_nationkey")


def _workers(spark, d):
    return _t(spark, d, "region").select(F.col("r_regionkey").alias("capture_id"))


@query(f"""WITH {_ASSIGN}, l AS (SELECT capture_id, count(keyspan_id) AS n FROM cap LEFT JOIN sp USING (capture_id) GROUP BY capture_id)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) // count(*) AS BIGINT) AS average, round(stddev_pop(n) / avg(n), 9) AS skewness FROM l""")
def workload_skew(spark, d):
    return placement.skew(placement.loads(_workers(spark, d), _assigned(spark, d))).withColumn("skewness", F.round("skewness", 9))


@query(f"""WITH {_ASSIGN}, l AS (SELECT capture_id, count(keyspan_id) AS n FROM cap LEFT JOIN sp USING (capture_id) GROUP BY capture_id) SELECT capture_id FROM l ORDER BY n, capture_id LIMIT 1""")
def least_loaded(spark, d):
    return placement.least_loaded(placement.loads(_workers(spark, d), _assigned(spark, d)))


_VICTIMS = f"""{_ASSIGN}, r AS (SELECT *, count(*) OVER (PARTITION BY capture_id) AS n, row_number() OVER (PARTITION BY capture_id ORDER BY keyspan_id) AS rn FROM sp),
  v AS (SELECT capture_id, keyspan_id FROM r WHERE rn <= n - (SELECT ceil(count(*) / 5.0) FROM sp))"""


@query(f"WITH {_VICTIMS} SELECT capture_id, keyspan_id FROM v")
def rebalance_victims(spark, d):
    return placement.victims(_workers(spark, d), _assigned(spark, d))


@query("WITH s AS (SELECT count(*) AS n FROM supplier) SELECT r_regionkey AS capture_id, CAST(n // 5 + CASE WHEN rank <= n % 5 THEN 1 ELSE 0 END AS BIGINT) AS spans FROM (SELECT r_regionkey, row_number() OVER (ORDER BY r_regionkey) AS rank FROM region), s")
def rebalance_spans(spark, d):
    return placement.rebalanced(_workers(spark, d), _assigned(spark, d)).groupBy("capture_id").agg(F.count("*").alias("spans"))


@query("""WITH a AS (SELECT s_suppkey AS keyspan_id FROM supplier WHERE s_suppkey % 3 <> 0), b AS (SELECT s_suppkey AS keyspan_id FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT keyspan_id, 'add' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT keyspan_id, 'remove' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def assignment_add_remove(spark, d):
    spans = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("keyspan_id"))
    return placement.assignment_changes(spans.filter("keyspan_id % 3 <> 0"), spans.filter("keyspan_id % 4 <> 0"))


@query("""SELECT s_suppkey AS keyspan_id FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE (s_suppkey + 1) % 7 = 0 AND s_suppkey + 1 IN (SELECT s_suppkey FROM supplier))""")
def related_span_wait(spark, d):
    spans = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("keyspan_id"))
    status = spans.select("keyspan_id", F.expr("case when keyspan_id % 7 = 0 then 'running' when keyspan_id % 2 = 0 then 'stopped' else 'processed' end").alias("status"))
    return placement.ready(spans, status, spans.select("keyspan_id", (F.col("keyspan_id") + 1).alias("related_id")))


_FEED = "f AS (SELECT c_name AS id, CASE c_custkey % 6 WHEN 0 THEN 'normal' WHEN 1 THEN 'error' WHEN 2 THEN 'failed' WHEN 3 THEN 'stopped' WHEN 4 THEN 'finished' ELSE 'removed' END AS state, c_custkey FROM customer)"


def _feeds(spark, d):
    state = "case c_custkey % 6 when 0 then 'normal' when 1 then 'error' when 2 then 'failed' when 3 then 'stopped' when 4 then 'finished' else 'removed' end"
    return _t(spark, d, "customer").select(F.col("c_name").alias("id"), F.expr(state).alias("state"), "c_custkey")


@query(f"""WITH {_FEED}, s AS (SELECT o_custkey, max(o_orderkey) AS checkpoint_ts FROM orders GROUP BY o_custkey)
SELECT id, state, checkpoint_ts FROM f JOIN s ON c_custkey = o_custkey WHERE state IN ('normal', 'stopped', 'failed')""")
def feed_status_join(spark, d):
    status = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("checkpoint_ts"))
    feed = _feeds(spark, d)
    return feeds.with_status(feed, feed.join(status, "c_custkey").select("id", "checkpoint_ts"), "").select("id", "state", "checkpoint_ts")


@query(f"WITH {_FEED} SELECT state, CASE state WHEN 'normal' THEN 0 WHEN 'error' THEN 1 WHEN 'failed' THEN 2 WHEN 'stopped' THEN 3 WHEN 'finished' THEN 4 WHEN 'removed' THEN 5 ELSE -1 END AS code, count(*) AS n FROM f GROUP BY state")
def feed_state_codes(spark, d):
    return _feeds(spark, d).groupBy("state").agg(F.count("*").alias("n")).select("state", feeds.state_number("state").alias("code"), "n")


_POS = "p AS (SELECT user_id AS capture_id, max(epoch_us(ts)) AS resolved_ts, max(epoch_us(ts)) - user_id * 1000 AS checkpoint_ts FROM events GROUP BY user_id)"


def _positions(spark, d):
    return _log(spark, d).groupBy(F.col("user_id").alias("capture_id")).agg(F.max("crts").alias("resolved_ts"), (F.max("crts") - F.col("user_id") * 1000).alias("checkpoint_ts"))


@query(f"WITH {_POS} SELECT min(resolved_ts) AS resolved_ts, least(min(checkpoint_ts), min(resolved_ts)) AS checkpoint_ts FROM p")
def local_watermark(spark, d):
    return watermarks.local_watermark(_positions(spark, d))


@query(f"WITH {_POS} SELECT min(resolved_ts) AS resolved_ts, min(checkpoint_ts) AS checkpoint_ts FROM p WHERE capture_id IN (SELECT s_suppkey FROM supplier)")
def global_watermark(spark, d):
    owners = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("capture_id"))
    return watermarks.global_watermark(_positions(spark, d), owners=owners)


@query(f"WITH {_POS}, x AS (SELECT resolved_ts, checkpoint_ts FROM p UNION ALL SELECT epoch_us(ts), epoch_us(ts) FROM events WHERE event_type = 'signup' AND event_id % 97 = 5) SELECT min(resolved_ts) AS resolved_ts, min(checkpoint_ts) AS checkpoint_ts FROM x")
def watermark_with_pending_ops(spark, d):
    pending = _log(spark, d).filter("event_type = 'signup' and event_id % 97 = 5").select(F.col("crts").alias("boundary_ts"))  # operations that have not ended
    return watermarks.global_watermark(_positions(spark, d), pending)


@query(f"{_CH}, m AS (SELECT user_id % 8 AS partition, max(crts) AS m FROM ch GROUP BY 1) SELECT min(m) AS resolved_ts FROM m")
def consumer_global_resolved(spark, d):
    return watermarks.consumer_watermark(_log(spark, d).select(F.expr("user_id % 8").alias("partition"), F.col("crts").alias("resolved_ts")))


@query(f"{_CH} SELECT event_id, least(crts, 1704672000000000, crts - (event_id % 3 - 1) * 1000000) AS bound FROM ch")
def target_ts_bounded(spark, d):
    log = _log(spark, d).withColumn("barrier", F.expr("crts - (event_id % 3 - 1) * 1000000"))
    return log.select("event_id", watermarks.bounded("crts", F.lit(1_704_672_000_000_000), "barrier").alias("bound"))


@query("WITH t AS (SELECT DISTINCT user_id, epoch_us(ts) // 3600000000 AS hour FROM events), n AS (SELECT *, lead(hour) OVER (PARTITION BY user_id ORDER BY hour) AS completed_by FROM t) SELECT user_id, hour, completed_by FROM n WHERE completed_by IS NOT NULL")
def resolved_interpolation(spark, d):
    log = _log(spark, d).withColumn("hour", F.expr("crts div 3600000000"))
    return watermarks.interpolated(log, "user_id", "hour")


@query(f"WITH {_FEED} SELECT min(CASE WHEN state IN ('normal', 'stopped', 'error') THEN c_custkey + 1000 END) - 1 AS safe_point FROM f")
def gc_safe_point(spark, d):
    return watermarks.gc_bound(_feeds(spark, d).withColumn("checkpoint_ts", F.col("c_custkey") + 1000))


@query("SELECT o_orderkey, CASE WHEN o_custkey > 0 AND o_custkey < o_orderkey THEN o_custkey ELSE o_orderkey END AS safe_point FROM orders")
def new_gc_safe_point(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", watermarks.new_safe_point("o_custkey", "o_orderkey").alias("safe_point"))


@query("""WITH s AS (SELECT user_id, epoch_us(ts) // 1000 AS now_ms, event_id AS count FROM events), g AS (SELECT *, lag(now_ms) OVER w AS pm, lag(count) OVER w AS pc FROM s WINDOW w AS (PARTITION BY user_id ORDER BY now_ms))
SELECT user_id, now_ms, round((count - pc) / ((now_ms - pm) / 1000.0), 6) AS ops, CAST(500 AS BIGINT) AS sink_gap_ms, CAST(1500 AS BIGINT) AS replication_gap_ms FROM g WHERE pm IS NULL OR now_ms > pm""")
def feed_statistics(spark, d):
    ms = F.expr("crts div 1000")
    samples = _log(spark, d).select("user_id", ms.alias("now_ms"), F.col("event_id").alias("count"), timestamps.compose(ms - 1000).alias("resolved_ts"), timestamps.compose(ms - 1500).alias("checkpoint_ts"))
    out = watermarks.feed_statistics(samples, "user_id")
    return out.select("user_id", "now_ms", F.round("ops", 6).alias("ops"), "sink_gap_ms", "replication_gap_ms")


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms, event_id % 7 AS logical, greatest(epoch_us(ts) // 1000 - 3000, 0) AS safe_ms FROM events")
def timestamp_parts(spark, d):
    log = _log(spark, d).withColumn("ts", timestamps.compose(F.expr("crts div 1000"), F.expr("event_id % 7")))
    return log.select("event_id", timestamps.physical_ms("ts").alias("ms"), timestamps.logical("ts").alias("logical"), timestamps.physical_ms(watermarks.safe("ts")).alias("safe_ms"))


@query("SELECT o_orderkey AS region_id, epoch_us(o_orderdate) AS resolved_ts FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 64")
def oldest_regions(spark, d):
    marks = _t(spark, d, "orders").select(F.col("o_orderkey").alias("region_id"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)").alias("resolved_ts"))
    return placement.oldest(marks)


# --- files, checksums, bulk loads ---------------------------------------------------------------------------

_FILES = f"""files AS (SELECT 'f' || CAST(o_orderkey % 5000 AS VARCHAR) AS name, CASE WHEN o_orderkey % 5 = 0 THEN 'write' ELSE 'default' END AS cf, {_K('o_orderkey')} AS start_key, {_K('o_orderkey + 1')} AS end_key,
  o_custkey AS total_kvs, CAST(floor(o_totalprice) AS BIGINT) AS total_bytes, o_orderkey * 7919 AS crc64xor, CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders)"""


def _files(spark, d):
    return _t(spark, d, "orders").select(
        F.concat(F.lit("f"), F.expr("cast(o_orderkey % 5000 as string)")).alias("name"), F.expr("if(o_orderkey % 5 = 0, 'write', 'default')").alias("cf"), _key("o_orderkey").alias("start_key"), _key("o_orderkey + 1").alias("end_key"),
        F.col("o_custkey").alias("total_kvs"), F.expr("cast(floor(o_totalprice) as bigint)").alias("total_bytes"), F.expr("o_orderkey * 7919").alias("crc64xor"), F.expr("cast(floor(o_totalprice) as bigint)").alias("size"),
    )


@query(f"WITH {_FILES} SELECT cf, bit_xor(crc64xor) AS crc64_xor, CAST(sum(total_kvs) AS BIGINT) AS total_kvs, CAST(sum(total_bytes) AS BIGINT) AS total_bytes FROM files GROUP BY cf")
def xor_checksum_merge(spark, d):
    return checksums.merged(_files(spark, d), "cf")


@query(f"WITH {_FILES} SELECT name, count(*) AS n FROM files GROUP BY name HAVING count(*) > 1")
def dup_file_names(spark, d):
    return backups.duplicate_names(_files(spark, d))


@query(f"WITH {_FILES} SELECT name, start_key, end_key FROM files WHERE cf = 'default' AND end_key >= 'u00000100' AND start_key < 'u00000900'")
def metadata_file_prune(spark, d):
    whole = spark.range(1).select(F.lit(b"").alias("start"), F.lit(None).cast("binary").alias("end"))
    return backups.select_files(_files(spark, d), whole, b"u00000100", b"u00000900").select("name", _text("start_key"), _text("end_key"))


@query(f"WITH {_FILES} SELECT CAST(sum(size) AS BIGINT) AS size FROM files")
def archive_size(spark, d):
    return backups.archive_size(_files(spark, d))


@query(f"WITH {_FILES} SELECT start_key, sum(total_bytes)::BIGINT AS total_bytes, sum(total_kvs)::BIGINT AS total_kvs FROM files GROUP BY start_key")
def files_by_start(spark, d):
    return backups.by_start(_files(spark, d)).select(_text("start_key"), "total_bytes", "total_kvs")


@query("""WITH RECURSIVE f AS (SELECT o_custkey AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS b, o_orderkey % 1000 AS k FROM orders),
  m AS (SELECT c, rn, o_orderkey, b AS sb, k AS sk, CAST(0 AS BIGINT) AS g FROM f WHERE rn = 1 UNION ALL
    SELECT f.c, f.rn, f.o_orderkey, CASE WHEN f.b = 0 OR (sb + f.b <= 500000 AND sk + f.k <= 2000) THEN sb + f.b ELSE f.b END, CASE WHEN f.b = 0 OR (sb + f.b <= 500000 AND sk + f.k <= 2000) THEN sk + f.k ELSE f.k END,
      g + CASE WHEN f.b = 0 OR (sb + f.b <= 500000 AND sk + f.k <= 2000) THEN 0 ELSE 1 END FROM m JOIN f ON f.c = m.c AND f.rn = m.rn + 1)
SELECT o_orderkey, c AS o_custkey, g AS "group" FROM m""")
def range_merge_greedy(spark, d):
    files = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.expr("cast(floor(o_totalprice) as bigint)").alias("total_bytes"), F.expr("o_orderkey % 1000").alias("total_kvs"))
    return folds.merge_ranges(files, "o_custkey", "o_orderkey", 500_000, 2000).select("o_orderkey", "o_custkey", "group")


@query(f"""WITH {_FILES}, k AS (SELECT greatest(count(*) FILTER (cf = 'default'), count(*) FILTER (cf = 'write')) AS n, sum(total_bytes)::BIGINT AS b, sum(total_kvs)::BIGINT AS v FROM files), m AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT k.n AS total_regions, m.n AS merged_regions, b // k.n AS region_bytes, v // k.n AS region_kvs, b // m.n AS merged_bytes, v // m.n AS merged_kvs FROM k, m""")
def merge_statistics(spark, d):
    return folds.merge_statistics(_files(spark, d), _t(spark, d, "orders").select("o_custkey").distinct())


@query("""WITH s AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders WHERE o_orderkey % 11 <> 0), t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1 ELSE o_custkey END AS v FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(s.k, t.k) AS key, CASE WHEN t.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'extra' ELSE 'changed' END AS difference FROM s FULL JOIN t ON s.k = t.k WHERE t.k IS NULL OR s.k IS NULL OR s.v <> t.v""")
def reconcile_source_target(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("value"))
    target = o.filter("key % 7 <> 0").withColumn("value", F.expr("if(key % 13 = 0, value + 1, value)"))
    return checksums.differences(o.filter("key % 11 <> 0"), target)


@query("""WITH k AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS key FROM lineitem), n AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS r, count(*) OVER () AS c FROM k)
SELECT CAST(r // (c // 17) AS BIGINT) AS place, key FROM n WHERE r % (c // 17) = 0 AND r > 0 AND r <= (c // 17) * 16""")
def equi_depth_split_points(spark, d):
    keys = _t(spark, d, "lineitem").select(F.expr("l_orderkey * 10 + l_linenumber").alias("key")).distinct()
    return bulkload.split_points(keys, 16)


@query(f"""{_CH}, {_REG}, one AS (SELECT key, max(value) AS value FROM ch GROUP BY key) SELECT region_id, key, value FROM one JOIN reg ON key >= "start" AND ("end" IS NULL OR key < "end")""")
def bulk_load(spark, d):
    done = bulkload.ingest(_log(spark, d).select("key", "value"), _shared(spark, "load"))
    return bulkload.assign(done, _regions(spark, d), "region_id").select("region_id", _text("key"), _text("value"))


@query("SELECT true AS equal")
def backup_verify(spark, d):
    pairs = _t(spark, d, "orders").select(_key("o_orderkey").alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"))
    path = _shared(spark, "backup")
    backups.backup(pairs, path)
    return backups.verify(spark, path)


@query(f"SELECT {_K('o_orderkey')} AS key, o_orderstatus AS value FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 900")
def backup_restore(spark, d):
    pairs = _t(spark, d, "orders").select(_key("o_orderkey").alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"))
    path = _shared(spark, "backup")
    backups.backup(pairs, path)
    return backups.restore(spark, path, b"u00000100", b"u00000900").select(_text("key"), _text("value"))


#: CRC-64 of a string of ASCII characters after the prefix of the second format, by bits, as a BIGINT's bit pattern.
_CRC64 = """xor(list_reduce(list_prepend(18446744073709551615::UBIGINT, list_concat([114, 0, 0, 0]::UBIGINT[], list_transform(string_split({}, ''), lambda x: CAST(ord(x) AS UBIGINT)))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 14514072000185962306::UBIGINT) ELSE x >> 1 END)), 18446744073709551615::UBIGINT)""".format
_SIGNED = "CAST(CASE WHEN {0} > 9223372036854775807 THEN CAST({0} AS HUGEINT) - 18446744073709551616 ELSE CAST({0} AS HUGEINT) END AS BIGINT)".format


@query(f"""{_CH}, each AS (SELECT event_type, {_CRC64("key || value")} AS crc, 4 + strlen(key) + strlen(value) AS bytes FROM ch)
SELECT event_type, {_SIGNED("bit_xor(crc)")} AS crc64_xor, count(*) AS total_kvs, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM each GROUP BY event_type""")
def crc64_checksum(spark, d):
    return checksums.checksum(_log(spark, d), "event_type")


_M32, _M64 = "CAST(({}) & 4294967295 AS UBIGINT)".format, "(({}) & 18446744073709551615::UHUGEINT)".format
_ROT32, _ROT64 = "((({0}) << {1}) | (({0}) >> (32 - {1}))) & 4294967295".format, "((({0}) << {1}::UHUGEINT) | (({0}) >> (64 - {1})::UHUGEINT)) & 18446744073709551615::UHUGEINT".format


def _bytes_of(first: int, n: int, kind: str) -> str:
    """SQL of n characters of a key, from the given one, as a little-endian number."""
    return "(" + " + ".join(f"CAST(ord(substr(key, {first + i}, 1)) AS {kind}) * {256**i}::{kind}" for i in range(n)) + ")"


def _murmur_steps() -> str:
    """SQL of both hashes of keys of nine bytes: two words (or one of eight bytes) and a tail of one byte."""
    steps = [("b0", "SELECT event_id, key, 0::UBIGINT AS h FROM ch")]
    for n, word in enumerate((_bytes_of(1, 4, "UBIGINT"), _bytes_of(5, 4, "UBIGINT"))):
        steps.append((f"k{n}", f"SELECT *, {_M32(f'{word} * 3432918353::UBIGINT')} AS k FROM b{n}"))
        steps.append((f"r{n}", f"SELECT event_id, key, h, {_M32(f'({_ROT32('k', 15)}) * 461845907::UBIGINT')} AS k FROM k{n}"))
        steps.append((f"b{n + 1}", f"SELECT event_id, key, {_M32(f'({_ROT32('xor(h, k)', 13)}) * 5 + 3864292196::UBIGINT')} AS h FROM r{n}"))
    steps.append(("t0", f"SELECT event_id, key, h, {_M32(f'{_bytes_of(9, 1, "UBIGINT")} * 3432918353::UBIGINT')} AS k FROM b2"))
    steps.append(("t1", f"SELECT event_id, key, xor(xor(h, {_M32(f'({_ROT32('k', 15)}) * 461845907::UBIGINT')}), 9::UBIGINT) AS h FROM t0"))
    steps.append(("t2", f"SELECT event_id, key, {_M32('xor(h, h >> 16) * 2246822507::UBIGINT')} AS h FROM t1"))
    steps.append(("t3", f"SELECT event_id, key, {_M32('xor(h, h >> 13) * 3266489909::UBIGINT')} AS h FROM t2"))
    c1, c2 = "9782798678568883157::UHUGEINT", "5545529020109919103::UHUGEINT"
    steps.append(("w0", f"SELECT event_id, xor(h, h >> 16) % 16 AS bucket, {_M64(f'{_bytes_of(1, 8, "UHUGEINT")} * {c1}')} AS a, {_M64(f'{_bytes_of(9, 1, "UHUGEINT")} * {c2}')} AS b FROM t3"))
    steps.append(("w1", f"SELECT event_id, bucket, xor({_M64(f'({_ROT64('a', 31)}) * {c2}')}, 9::UHUGEINT) AS a, xor({_M64(f'({_ROT64('b', 33)}) * {c1}')}, 9::UHUGEINT) AS b FROM w0"))
    steps.append(("w2", f"SELECT event_id, bucket, {_M64('a + b')} AS a, {_M64('a + b + b')} AS b FROM w1"))
    for n, by in ((2, "18397679294719823053::UHUGEINT"), (3, "14181476777654086739::UHUGEINT")):
        steps.append((f"w{n + 1}", f"SELECT event_id, bucket, {_M64(f'xor(a, a >> 33::UHUGEINT) * {by}')} AS a, {_M64(f'xor(b, b >> 33::UHUGEINT) * {by}')} AS b FROM w{n}"))
    steps.append(("w5", f"SELECT event_id, bucket, {_M64('xor(a, a >> 33::UHUGEINT) + xor(b, b >> 33::UHUGEINT)')} AS id FROM w4"))
    return ", ".join(f"{name} AS ({sql})" for name, sql in steps)


@query(f"""{_CH}, {_murmur_steps()} SELECT event_id, CAST(bucket AS INTEGER) AS bucket, {_SIGNED("id")} AS id FROM w5""")
def span_hash_dispatch(spark, d):
    return _log(spark, d).select("event_id", hashes.dispatch("key", 16).alias("bucket"), hashes.murmur3_64("key").alias("id"))


# --- messages and streams -----------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {_CH.removeprefix("WITH ")},
e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY crts, sequence) AS n, strlen('{{"ts":' || crts || ',"k":"' || to_base64(encode(key)) || '","t":4}}')
  + strlen('{{"op":' || op_type || ',"v":"' || to_base64(encode(value)) || '"' || CASE WHEN expired_ts <> 0 THEN ',"ex":' || expired_ts ELSE '' END || '}}') AS size FROM ch),
f AS (SELECT user_id, n, size, CAST(0 AS BIGINT) AS grp, size + 60 AS held, 1 AS entries FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.n, e.size, CASE WHEN cut THEN grp + 1 ELSE grp END, CASE WHEN cut THEN e.size + 60 ELSE held + e.size + 16 END, CASE WHEN cut THEN 1 ELSE entries + 1 END
  FROM (SELECT *, n + 1 AS next FROM f) f JOIN e ON e.user_id = f.user_id AND e.n = f.next, LATERAL (SELECT entries >= 8 OR held + e.size + 16 > 1024 AS cut))
SELECT user_id, grp AS "group", count(*) AS entries, CAST(sum(size) AS BIGINT) AS bytes FROM f GROUP BY user_id, grp""")
def message_packing(spark, d):
    sizes = _log(spark, d).withColumns({"key_bytes": F.length(codec.entry_key()), "value_bytes": F.length(codec.entry_value())}).select("user_id", "crts", "sequence", "key_bytes", "value_bytes")
    return folds.pack_messages(sizes, "user_id", ["crts", "sequence"], 1024, 8).groupBy("user_id", "group").agg(F.count("*").alias("entries"), F.sum(F.col("key_bytes") + F.col("value_bytes")).alias("bytes"))


@query(f"{_CH} SELECT user_id, op_type, key, value, crts, expired_ts FROM ch")
def open_protocol_roundtrip(spark, d):
    messages = codec.encode(_log(spark, d), "user_id", 2048, 16)
    return codec.decode(messages, "user_id").select("user_id", "op_type", _text("key"), _text("value"), "crts", "expired_ts")


@query("SELECT CAST(r AS INTEGER) AS partition, CAST(3 AS INTEGER) AS op_type, CAST(4243 AS BIGINT) AS crts FROM range(6) t(r)")
def checkpoint_broadcast(spark, d):
    return codec.decode(codec.broadcast_checkpoint(4243, _t(spark, d, "region"), 6), "partition").select("partition", "op_type", "crts")


@query(f"""{_CH}, last AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY crts DESC, sequence DESC) AS rn FROM ch)
SELECT key, value, crts, sequence FROM last WHERE rn = 1 AND op_type = 1""")
def stream_state_materialise(spark, d):
    schema = _t(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")  # a pattern may match a single file too
    state = apply.materialise(logs.changes_of_events(events), _shared(spark, "stream"))
    return state.select(_text("key"), _text("value"), "crts", "sequence")


# --- keyed state of a feed's regions ------------------------------------------------------------------------


def _streamed(spark, rows: DataFrame, made, name: str) -> DataFrame:
    """What a stream over the first and then the second half of the rows (by sequence) puts out; between the halves it
    is stopped and goes on from its checkpoint."""
    path, half = _shared(spark, name), F.broadcast(rows.agg(F.max("sequence").alias("last")))  # one row
    for second in (False, True):
        part = rows.crossJoin(half).filter((F.col("sequence") * 2 > F.col("last")) == F.lit(second)).drop("last")
        part.write.mode("append").parquet(f"{path}/in")
        out = made(spark.readStream.schema(rows.schema).parquet(f"{path}/in")).writeStream.format("parquet").option("path", f"{path}/out")
        out.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _initialized(events: DataFrame) -> DataFrame:
    """A marker a region, between the events' rows: (region_id, sequence)."""
    last = events.agg(F.max("event_id").alias("last"))
    return events.select((F.col("user_id") % 7).alias("region_id")).distinct().crossJoin(F.broadcast(last)).select("region_id", F.expr("10 * (last * (region_id + 1) div 10) + 9").alias("sequence"))


def _feed(spark, d) -> DataFrame:
    """Events as a feed: a prewrite, for every fifth a sign of life, for errors a rollback, and a commit, which for
    every eleventh comes before its prewrite."""
    log = _log(spark, d).select((F.col("user_id") % 7).alias("region_id"), "key", "value", "crts", "event_id", "event_type")
    early = F.col("event_id") % 11 == 0
    none = F.lit(None).cast("binary")
    kinds = F.array(
        F.struct(F.lit("prewrite").alias("kind"), (F.col("event_id") * 10).alias("sequence"), F.col("value").alias("v")),
        F.when(F.col("event_id") % 5 == 0, F.struct(F.lit("prewrite").alias("kind"), (F.col("event_id") * 10 + 1).alias("sequence"), none.alias("v"))),
        F.when(F.col("event_type") == "error", F.struct(F.lit("rollback").alias("kind"), (F.col("event_id") * 10 + 2).alias("sequence"), none.alias("v"))),
        F.struct(F.lit("commit").alias("kind"), (F.col("event_id") * 10 + F.when(early, -3).otherwise(3)).alias("sequence"), none.alias("v")),
    )
    rows = log.withColumn("e", F.explode(kinds)).filter("e is not null").select("region_id", "e.kind", "key", F.col("event_id").alias("start_ts"), "crts", F.lit(1).alias("op_type"), F.col("e.v").alias("value"), none.alias("old_value"), "e.sequence")
    marks = _initialized(_t(spark, d, "events")).select("region_id", F.lit("initialized").alias("kind"), none.alias("key"), F.lit(None).cast("bigint").alias("start_ts"), F.lit(None).cast("bigint").alias("crts"), F.lit(1).alias("op_type"), none.alias("value"), none.alias("old_value"), "sequence")
    return rows.union(marks)


_INIT = "init AS (SELECT user_id % 7 AS region_id, 10 * ((SELECT max(event_id) FROM events) * (user_id % 7 + 1) // 10) + 9 AS seen FROM events GROUP BY 1, 2)"


@query(f"""{_CH}, {_INIT}, c AS (SELECT user_id % 7 AS region_id, event_id, event_type, key, value, event_id * 10 + CASE WHEN event_id % 11 = 0 THEN -3 ELSE 3 END AS sequence FROM ch),
  m AS (SELECT c.*, seen, event_type <> 'error' AND (event_id % 11 <> 0 OR (sequence < seen AND event_id * 10 < seen)) AS ok FROM c JOIN init USING (region_id))
SELECT region_id, sequence, key, CASE WHEN ok THEN value END AS value, CASE WHEN NOT ok THEN 'commit without a prewrite' END AS error FROM m WHERE ok OR sequence > seen""")
def matched_commits_stream(spark, d):
    out = _streamed(spark, _feed(spark, d), regions.match_commits, "matched")
    return out.select("region_id", "sequence", _text("key"), _text("value"), "error")


@query(f"""{_CH}, {_INIT}, m AS (SELECT user_id % 7 AS region_id, event_id * 10 AS sequence, crts, seen FROM ch JOIN init ON user_id % 7 = region_id),
  r AS (SELECT *, max(crts) OVER w AS high FROM m WHERE sequence > seen WINDOW w AS (PARTITION BY region_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  a AS (SELECT *, high IS NULL OR crts >= high AS ok, sum(CASE WHEN crts < high THEN 1 ELSE 0 END) OVER (PARTITION BY region_id ORDER BY sequence) AS regressed FROM r),
  i AS (SELECT region_id, count(*) FILTER (WHERE sequence < seen) AS ignored FROM m GROUP BY region_id)
SELECT region_id, sequence, crts AS resolved_ts, ignored, CAST(regressed AS BIGINT) AS regressed FROM a JOIN i USING (region_id) WHERE ok""")
def region_clock_stream(spark, d):
    none = F.lit(None).cast("bigint").alias("crts")
    marks = _log(spark, d).select((F.col("user_id") % 7).alias("region_id"), F.lit("resolved").alias("kind"), "crts", (F.col("event_id") * 10).alias("sequence"))
    rows = marks.union(_initialized(_t(spark, d, "events")).select("region_id", F.lit("initialized").alias("kind"), none, "sequence"))
    return _streamed(spark, rows, regions.region_clocks, "clocks").select("region_id", "sequence", "resolved_ts", "ignored", "regressed")


@query(f"""{_CH}, m AS (SELECT user_id % 7 AS region_id, event_id, crts, CASE WHEN event_id * 2 > (SELECT max(event_id) FROM events) THEN 2 ELSE 1 END AS half FROM ch),
  low AS (SELECT b.half, min(last) AS frontier FROM (SELECT h.half, region_id, arg_max(crts, event_id) AS last FROM m JOIN (VALUES (1), (2)) h(half) ON m.half <= h.half GROUP BY h.half, region_id) b GROUP BY b.half)
SELECT frontier, max(frontier) OVER (ORDER BY half) AS emitted FROM low""")
def feed_frontier_stream(spark, d):
    region = F.col("user_id") % 7
    marks = _log(spark, d).select(F.lit("feed").alias("feed"), _key(region * 10).alias("start"), _key(region * 10 + 10).alias("end"), F.col("crts").alias("resolved_ts"), F.col("event_id").alias("arrival"), F.col("event_id").alias("sequence"))
    cuts = [b"u00000025", b"u00000050"]
    return _streamed(spark, marks, lambda s: frontier.frontier_stream(s, cuts), "frontier").select("frontier", "emitted")


@query(f"""{_CH}, b AS (SELECT min(crts) + {_DAY} AS low FROM ch), e AS (SELECT user_id % 5 AS region_id, key, value, crts FROM ch, b WHERE crts > low)
SELECT region_id, 'committed' AS kind, key, value, crts FROM e
UNION ALL SELECT region_id, 'resolved', '', '', max(crts) FROM e GROUP BY region_id UNION ALL SELECT DISTINCT user_id % 5, 'initialized', '', '', 0 FROM events""")
def feed_source_stream(spark, d):
    """A feed of two appends, read from a day after its first entry in batches of 256 KB, stopped between the appends."""
    path, log = _shared(spark, "feed"), _log(spark, d)
    low, high = log.agg(F.min("crts"), F.max("crts")).first()
    entries = log.select((F.col("user_id") % 5).alias("region_id"), "key", F.col("crts").alias("start_ts"), "crts", "op_type", "value", F.lit(None).cast("binary").alias("old_value"))
    for number, second in enumerate((False, True)):
        feed.append_feed(entries.filter((F.col("crts") > (low + high) // 2) == second), f"{path}/feed", number, 32 << 10)
        stream = feed.stream_feed(spark, f"{path}/feed", start_ts=low + _DAY, max_bytes=256 << 10, progress=f"{path}/progress")
        with plain_logs(spark, path):
            running = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/progress").start()
            running.processAllAvailable()
        running.stop()
    rows = spark.read.parquet(f"{path}/out").select("region_id", "kind", _text("key"), _text("value"), "crts").na.fill("").na.fill(0)
    last = rows.filter("kind = 'resolved'").groupBy("region_id", "kind", "key", "value").agg(F.max("crts").alias("crts"))
    return rows.filter("kind <> 'resolved'").union(last)


@query(f"""{_CH}, e AS (SELECT user_id % 3 AS keyspan_id, crts, op_type, key, value, sequence * 2 AS sequence, CASE WHEN sequence * 4 > 2 * (SELECT max(sequence) FROM ch) + 1 THEN 2 ELSE 1 END AS half FROM ch),
  m AS (SELECT keyspan_id, max(crts) - {_DAY} AS crts, 3 AS op_type, max(sequence) + 1 AS sequence, half FROM e GROUP BY keyspan_id, half),
  r AS (SELECT a.keyspan_id, a.crts, a.op_type, a.key, a.value, a.sequence, min(m.half) AS batch FROM (SELECT * FROM e UNION ALL SELECT keyspan_id, crts, op_type, '' AS key, '' AS value, sequence, half FROM m) a
    JOIN m ON a.keyspan_id = m.keyspan_id AND m.half >= a.half AND a.crts <= m.crts GROUP BY ALL)
SELECT keyspan_id, row_number() OVER (PARTITION BY keyspan_id ORDER BY batch, crts, op_type = 3, sequence) - 1 AS place, crts, op_type, key, value FROM r""")
def ordered_release_stream(spark, d):
    """Entries of three spans in two batches, each with a marker a day behind its newest entry."""
    log = _log(spark, d)
    half = F.when(F.col("event_id") * 4 > F.col("last") * 2 + 1, 2).otherwise(1)
    entries = log.crossJoin(F.broadcast(log.agg(F.max("event_id").alias("last")))).select((F.col("user_id") % 3).alias("keyspan_id"), "crts", "op_type", "key", "value", (F.col("event_id") * 2).alias("sequence"), half.alias("half"))
    none = F.lit(None).cast("binary")
    marks = entries.groupBy("keyspan_id", "half").agg((F.max("crts") - _DAY).alias("crts"), (F.max("sequence") + 1).alias("sequence"))
    rows = entries.drop("half").unionByName(marks.select("keyspan_id", "crts", F.lit(changelog.RESOLVED).alias("op_type"), none.alias("key"), none.alias("value"), "sequence"))
    out = _streamed(spark, rows, release.ordered_release, "release")
    return out.select("keyspan_id", "place", "crts", "op_type", F.coalesce(F.decode("key", "UTF-8"), F.lit("")).alias("key"), F.coalesce(F.decode("value", "UTF-8"), F.lit("")).alias("value"))


@query(f"""{_CH} SELECT op_type, key, value, crts, count(*) AS n FROM ch GROUP BY ALL
UNION ALL SELECT 3, '', '', max(crts), 4 FROM ch""")
def queue_sink_stream(spark, d):
    """A log and its marker through a queue of four partitions, opened by URI."""
    path, log = _shared(spark, "queue"), _log(spark, d).select("op_type", "key", "value", "crts", "sequence")
    mark = log.agg(F.max("crts").alias("crts"), F.max("sequence").alias("sequence")).select(F.lit(changelog.RESOLVED).alias("op_type"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), "crts", "sequence")
    log.union(mark).write.parquet(f"{path}/in")
    where = path.split("://", 1)
    scheme, place = where if len(where) == 2 else ("file", where[0])
    place = "/" + place.lstrip("/") if scheme == "file" else place
    stream = spark.readStream.schema(log.schema).parquet(f"{path}/in")
    sinks.open_sink(stream, f"queue://{place}/q?partitions=4&fs={scheme}").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    rows = sinks.read_queue(spark, f"{scheme}://{place}/q").select("partition", "op_type", "crts", *[F.coalesce(F.decode(c, "UTF-8"), F.lit("")).alias(c) for c in ("key", "value")])
    return rows.groupBy("op_type", "key", "value", "crts").agg(F.count("*").alias("n"))


@query(f"""WITH {_REG}, p AS (SELECT {_K('o_orderkey')} AS key, any_value(o_orderstatus) AS value FROM orders GROUP BY o_orderkey)
SELECT CAST(region_id AS BIGINT) AS region_id, 'w' || key AS key, value FROM p JOIN reg ON key >= "start" AND ("end" IS NULL OR key < "end") WHERE key >= 'u00000020'""")
def restore_by_region(spark, d):
    """A backup of orders restored under another prefix, by cuts of files and regions."""
    pairs = _t(spark, d, "orders").select(_key("o_orderkey").alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"))
    path, moved = _shared(spark, "restore"), lambda c: F.concat(F.lit(b"w"), c)
    backups.backup(pairs, path)
    layout = _regions(spark, d).select("region_id", moved(F.col("start")).alias("start"), F.coalesce(moved(F.col("end")), F.lit(b"x")).alias("end"))
    return restore.restore_regions(spark, path, layout, b"wu00000020", b"x", [(b"u", b"wu")]).select("region_id", _text("key"), _text("value"))


@query("SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS name, 'default' AS cf, CAST(o_custkey AS BIGINT) AS total_kvs FROM orders")
def encrypted_manifest(spark, d):
    """A file an order in a manifest of encrypted documents, and what is read from it."""
    files = _t(spark, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name"), F.lit("default").alias("cf"), F.col("o_custkey").cast("bigint").alias("total_kvs"))
    path, key = _shared(spark, "manifest"), backups.new_key()
    manifests.write_manifest(files, path, key, 64 << 10)
    return manifests.read_manifest(spark, path, "name string, cf string, total_kvs bigint", key)


@query(f"""{_CH}, {_SP(a=_K('n_nationkey * 6'), b=_K('n_nationkey * 6 + 9'))}
SELECT event_id, EXISTS (SELECT 1 FROM sp WHERE "start" <= key AND {_K('user_id + 3')} <= "end") AS inside FROM ch""")
def spans_inside_parents(spark, d):
    """Three users' keys from each event's on as a span, against overlapping parents."""
    spans = _log(spark, d).select("event_id", F.col("key").alias("start"), _key("user_id + 3").alias("end"))
    return ranges.inside_any(spans, _spans(spark, d, 9)).select("event_id", "inside")


@query(f"""WITH {_REG} SELECT count(*) AS regions FROM reg WHERE "start" < 'u00000077' AND ("end" IS NULL OR "end" > 'u00000021')""")
def regions_in_range(spark, d):
    regions_ = _regions(spark, d)
    coded = regions_.select("region_id", K.encode_memcomparable("start").alias("start"), K.encode_memcomparable("end").alias("end"))
    return ranges.region_count(coded, b"u00000021", b"u00000077")


@query("""SELECT o_orderkey, greatest(5, least(90, o_custkey)) AS clamped, CAST(2 ** ceil(log2(o_orderkey + 1)) AS BIGINT) AS power,
  o_custkey & 1 <> 0 AND o_custkey & 6 <> 0 AS both, o_custkey & 7 <> 0 AS one, o_custkey | 8 AS added, xor(o_custkey, 4) AS toggled FROM orders""")
def flags_and_powers(spark, d):
    n = F.col("o_custkey").cast("bigint")
    return _t(spark, d, "orders").select(
        "o_orderkey", values.clamp(F.col("o_custkey"), 5, 90).alias("clamped"), values.next_power_of_two(F.col("o_orderkey") + 1).alias("power"),
        values.has_all(n, 1, 6).alias("both"), values.has_one(n, 1, 2, 4).alias("one"), values.with_flags(n, 8).alias("added"), values.toggled(n, 4).alias("toggled"),
    )


@query(f"""WITH p AS (SELECT DISTINCT {_K('o_orderkey')} AS key FROM orders)
SELECT CAST(1 AS BIGINT) AS succeeded, CAST(0 AS BIGINT) AS failed, count(*) AS rows, CAST(sum(strlen(key) + 1) AS BIGINT) AS bytes FROM p WHERE key >= 'u00000100' AND key < 'u00000900'""")
def restore_summary(spark, d):
    """Units, rows and bytes of a restore, counted by the job that writes it."""
    pairs = _t(spark, d, "orders").select(_key("o_orderkey").alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"))
    path, run = _shared(spark, "summary"), summary.RunSummary()
    backups.backup(pairs, path)
    rows = run.counted(backups.restore(spark, path, b"u00000100", b"u00000900"), "restore", F.length("key") + F.length("value"))
    with run.unit("restore"):
        rows.write.parquet(f"{path}/restored")
    return run.totals(spark).select("succeeded", "failed", "rows", "bytes")
