"""Queries over the training-data operators: (spark, sf_dir) -> DataFrame, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, conversation_repair, conversation_trie, decontaminate, line_dedup, media, minhash, quality_crf, simhash, substring_dedup, suffix_dedup, token_counts, token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("items", "tie")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_windows(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.shared_dir(spark, "media")
    media.write_media(_table(spark, sf_dir, "documents"), path)
    return media.media_features(media.read_media(spark, path))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_exact", "n_near", F.array_join("removed", ",").alias("removed"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.shared_dir(spark, "tokens")
    files = token_files.write_token_files(_table(spark, sf_dir, "documents"), path)
    return token_files.token_file_digests(token_files.read_token_files(spark, path, files))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_crf.classify(docs, quality_crf.train(docs, _table(spark, sf_dir, "labels")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_groups(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontaminate, op3_substring_dedup, op4_suffix_dedup, op5_simhash, op6_media, op7_line_dedup, op8_token_files, op9_quality, op10_byte_bpe, op11_conversation_trie, op12_minhash, op13_conversation_repair)}

#: CRC-32 of an id in decimal, by bits.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format

#: One row of an edit distance between x and y on five diagonals: d(k) is the distance of the first i characters of x
#: and the first i + k of y (9: more than two, or no such prefix).
_ROW = """list_reduce(list_prepend([0, 9, 9, 0, 1, 2]::BIGINT[], list_transform(string_split(x, ''), lambda c: [ord(c)]::BIGINT[])),
  lambda d, c: list_prepend(d[1] + 1, list_transform(range(-2, 3), lambda k: list_min(list_transform(range(-2, k + 1), lambda m: k - m + CASE WHEN d[1] + 1 + m < 0 OR d[1] + 1 + m > length(y) THEN 9
    ELSE least(d[m + 4] + CASE WHEN d[1] + 1 + m > 0 AND yc[d[1] + 1 + m] = c[1] THEN 0 ELSE 1 END, CASE WHEN m < 2 THEN d[m + 5] + 1 ELSE 9 END, 9) END)))))"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS size, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS win FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: {{'pos': i, 'win': array_to_string(w[i:i + size - 1], ' ')}})) AS x FROM d, (SELECT DISTINCT size FROM iw)),
hit AS (SELECT doc_id, x.pos AS pos, dw.size, item FROM dw JOIN iw ON iw.size = dw.size AND iw.win = x.win),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op3_substring_dedup": """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: {'pos': i, 'win': md5(array_to_string(w[i:i + 49], ' '))})) AS x FROM d),
e AS (SELECT doc_id, x.pos AS pos, doc_id > min(doc_id) OVER (PARTITION BY x.win) AS again FROM x),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS place FROM e WHERE again),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op4_suffix_dedup": """WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(coalesce(text, '')) AS h FROM documents),
blocks AS (SELECT doc_id, n, pos, substr(h, 2 * pos + 1, 2 * 799) AS part FROM (SELECT *, unnest(range(0, n - 199, 600)) AS pos FROM d)),
x AS (SELECT doc_id, pos + i AS pos, md5(substr(part, 2 * i + 1, 400)) AS s FROM (SELECT *, unnest(range(0, least(600, n - 199 - pos))) AS i FROM blocks)),
r AS (SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY s) AS many FROM x) WHERE many > 1),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM (SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 200 THEN 0 ELSE 1 END AS new FROM r)),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 200 AS z FROM runs GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, z FROM spans UNION ALL SELECT doc_id, n, n FROM d),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a, z), 0) AS since FROM edges) JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op7_line_dedup": f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT doc_id, place, line, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS nth FROM (SELECT doc_id, unnest(w) AS line, unnest(range(0, len(w))) AS place FROM d) WHERE line <> ''),
f AS (SELECT doc_id, place, line, length(line) AS n, CASE WHEN length(line) >= 20 THEN 2 WHEN length(line) >= 10 THEN 1 ELSE 0 END AS most FROM l WHERE nth = 1),
c AS (SELECT b.line, a.line AS y, b.line AS x, greatest(a.most, b.most) AS most, list_transform(string_split(a.line, ''), lambda c: CAST(ord(c) AS BIGINT)) AS yc FROM f a JOIN f b ON b.n BETWEEN a.n - 2 AND a.n + 2 AND greatest(a.most, b.most) > 0 AND (a.doc_id, a.place) < (b.doc_id, b.place)
  AND (contains(b.line, substr(a.line, 1, a.n // 3)) OR contains(b.line, substr(a.line, a.n // 3 + 1, a.n // 3)) OR contains(b.line, substr(a.line, 2 * (a.n // 3) + 1)))),
near AS (SELECT DISTINCT line FROM (SELECT line, most, ({_ROW})[length(y) - length(x) + 4] AS edits FROM c) WHERE edits <= most),
gone AS (SELECT doc_id, place, nth = 1 AS near FROM l WHERE nth > 1 OR line IN (SELECT line FROM near)),
n AS (SELECT doc_id, count(*) FILTER (WHERE NOT near) AS n_exact, count(*) FILTER (WHERE near) AS n_near, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed FROM d LEFT JOIN n USING (doc_id)""",
    "op11_conversation_trie": f"""WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos FROM t),
h AS (SELECT c, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
parts AS (SELECT h.c, 0 AS part, pos, role, text FROM h JOIN own o ON o.c = h.c - h.c % 5 AND pos <= h UNION ALL SELECT h.c, 1, pos, role, text FROM h JOIN own o ON o.c = h.c AND pos > h),
seq AS (SELECT h.c, coalesce(list({{'role': role, 'text': text}} ORDER BY part, pos) FILTER (WHERE part IS NOT NULL), []) AS turns FROM h LEFT JOIN parts USING (c) GROUP BY h.c),
each AS (SELECT c, len(turns) AS size, d, turns[1:d] AS node FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM seq)),
n AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '') AS ends,
  CASE WHEN d = 0 THEN 0 ELSE strlen(node[d].text) END AS bytes FROM each GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT n.*, coalesce(kids, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (SELECT node[1:up] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM a) GROUP BY ALL)
SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM a JOIN s USING (node) LEFT JOIN n p ON a.d > 0 AND p.node = a.node[1:a.d - 1]""",
    "op12_minhash": """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, x.b FROM r JOIN (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) x ON x.a = r.b)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(r.b) AS component_id, min(r.b) = doc_id AS kept FROM g JOIN r ON r.a = doc_id GROUP BY doc_id, g""",
}
