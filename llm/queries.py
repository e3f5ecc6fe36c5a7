"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from llm.common import let, table, text_or_empty
from llm.fingerprints import document_fingerprints
from llm.language_id import identify_language
from llm.line_dedup import MIN_SITES, MIN_WORDS, remove_shared_lines
from llm.mixing import mix_sources
from llm.near_dedup import near_duplicates
from llm.nearest import nearest_vectors
from llm.packing import pack_documents
from llm.periodic_runs import periodic_runs
from llm.quality import score_documents
from llm.ranked_search import ranked_search
from llm.sharding import byte_shards
from llm.surrogates import replace_entities
from llm.url_filters import RULES, rules_frame, url_verdicts


#: Key of the registered surrogate query; a real run has its own secret.
SURROGATE_KEY = "surrogates-of-the-registered-query"


def op1_order_minhash(spark, sf_dir):
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op2_collision_counting(spark, sf_dir):
    return nearest_vectors(table(spark, sf_dir, "embeddings"))


def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_byte_shards(spark, sf_dir):
    return byte_shards(table(spark, sf_dir, "documents"), 24)


def op5_pii_surrogates(spark, sf_dir):
    return (replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)
            .select("doc_id", "text", "n_entities"))


def op6_source_mixing(spark, sf_dir):
    return (mix_sources(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op7_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_url_filters(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"), rules_frame(spark))


def op9_line_dedup(spark, sf_dir):
    return (remove_shared_lines(table(spark, sf_dir, "documents"))
            .select("doc_id", "text", "n_lines", "removed_lines"))


def op10_quality_classifier(spark, sf_dir):
    return (score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "held_out", "score", "predicted"))


def op11_language_id(spark, sf_dir):
    return (identify_language(table(spark, sf_dir, "documents"))
            .select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"))


def planted_text():
    """The text of a row, with a periodic tail for every tenth ``crc32`` of a doc_id (op12's input)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = ((h - h % 10) / 10).cast("long")

    def tail(words):
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        word = lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(places, word), " ")).otherwise(F.lit(""))

    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, tail)).otherwise(F.col("text"))


def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_text().alias("text"))
    found = periodic_runs(docs)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = found.withColumn("_best", best.cast("struct<length:long,s:long,p:long,start:long,period:long>"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(text_or_empty("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_collision_counting": op2_collision_counting,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_byte_shards": op4_byte_shards,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_source_mixing": op6_source_mixing,
    "op7_packing": op7_packing,
    "op8_url_filters": op8_url_filters,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
    "pipeline": pipeline,
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

URL_SQL = rf"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts),
urls AS (SELECT rid, page_id, coalesce(host, '') AS host, coalesce(path, '') AS path FROM split),
hits AS (
  SELECT rid, page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC NULLS LAST, verdict DESC) AS k
  FROM urls LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE k = 1
"""

LINES_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, text, coalesce('0' || source, '1') AS site, string_split(text, chr(10)) AS ls
  FROM documents),
lines AS (
  SELECT rid, doc_id, text, site, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM docs WHERE text IS NOT NULL),
keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS k FROM lines
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {MIN_WORDS}),
shared AS (SELECT k FROM keyed GROUP BY k HAVING count(DISTINCT site) >= {MIN_SITES}),
placed AS (
  SELECT rid, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, pos) AS nth
  FROM keyed WHERE k IN (SELECT k FROM shared)),
gone AS (SELECT rid, pos FROM placed WHERE nth > 1),
rest AS (
  SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.rid IS NULL) AS text,
         count(*) AS n_lines, count(g.rid) AS removed_lines
  FROM lines l LEFT JOIN gone g ON l.rid = g.rid AND l.pos = g.pos GROUP BY l.rid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text,
       CAST(coalesce(r.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(r.removed_lines, 0) AS INTEGER) AS removed_lines
FROM docs d LEFT JOIN rest r ON d.rid = r.rid
"""

SHARDS_SQL = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT CAST(r.i AS BIGINT), CAST(r.i AS BIGINT), 0 FROM range(256) r(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents),
sized AS (
  SELECT rid, doc_id, size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM docs, crc_table),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size, rid) - size AS before, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size, rid) AS n
  FROM sized),
cut AS (SELECT *, CAST(least(23, ((2 * before + size) * 24) // (2 * total)) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

RUNS_SQL = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT CAST(r.i AS BIGINT), CAST(r.i AS BIGINT), 0 FROM range(256) r(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents),
hashed AS (
  SELECT rid, doc_id, ws, CAST(len(ws) AS BIGINT) AS n,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h
  FROM docs, crc_table),
placed AS (
  SELECT rid, doc_id, ws, n, coalesce(h % 10 = 0, false) AND n > 0 AS planted, h // 10 AS g,
         CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
texts AS (
  SELECT rid, doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws
  FROM periods),
grams AS (  -- a run has five words or more that recur one period later
  SELECT rid, n, unnest(range(n - 4)) AS i, unnest(list_transform(range(n - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' '))) AS gram
  FROM texts WHERE n >= 6),
pairs AS (
  SELECT x.rid, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.rid = y.rid AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT rid, q, min(i) AS start, count(*) + 4 + q AS length FROM islands GROUP BY rid, q, island),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
told AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY rid),
longest AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) AS k FROM runs),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT rid, unnest(range(n)) AS i, unnest(ws) AS w FROM texts),
kept AS (
  SELECT w.rid, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM words w LEFT JOIN gone g ON w.rid = g.rid AND w.i = g.i
  WHERE g.rid IS NULL GROUP BY w.rid)
SELECT d.doc_id, coalesce(t.n_runs, 0) AS n_runs, CAST(l.start AS BIGINT) AS start, CAST(l.length AS BIGINT) AS length,
       CAST(l.period AS BIGINT) AS period, CAST(1000 * l.length // l.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(t.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts d LEFT JOIN told t ON d.rid = t.rid LEFT JOIN longest l ON d.rid = l.rid AND l.k = 1 LEFT JOIN kept k ON d.rid = k.rid
"""

SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT *, CAST(len(ts) AS BIGINT) AS n FROM docs WHERE len(ts) > 0),
total AS (SELECT count(*) AS nn, CAST(coalesce(sum(n), 0) AS BIGINT) AS ll FROM sized),
lengths AS (SELECT rid, doc_id, 100 - 50 + (50 * n * nn) // ll AS m FROM sized, total),
items AS (
  SELECT row_number() OVER () AS qid, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark WHERE text IS NOT NULL),
wanted AS (SELECT DISTINCT qid, item_id, t FROM (SELECT qid, item_id, unnest(ts) AS t FROM items)),
held AS (SELECT rid, unnest(ts) AS t FROM sized),
postings AS (SELECT rid, t, count(*) AS tf FROM held WHERE t IN (SELECT t FROM wanted) GROUP BY rid, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), total),
scores AS (
  SELECT q.qid, q.item_id, p.rid, l.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * l.m))) AS BIGINT) AS score
  FROM wanted q JOIN postings p ON q.t = p.t JOIN weights w ON q.t = w.t JOIN lengths l ON p.rid = l.rid GROUP BY q.qid, q.item_id, p.rid, l.doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE = {
    "op12_periodic_runs": RUNS_SQL,
    "op13_ranked_search": SEARCH_SQL,
    "op4_byte_shards": SHARDS_SQL,
    "op8_url_filters": URL_SQL,
    "op9_line_dedup": LINES_SQL,
}
