"""Queries of this package on the driver's tables, with their check SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesada.llm.common import shared_dir
from mesada.llm.decontam import contaminated
from mesada.llm.importance import importance_sample
from mesada.llm.langid import language_predictions
from mesada.llm.lm import language_scores
from mesada.llm.negatives import hard_negatives
from mesada.llm.pii import pii_spans
from mesada.llm.prefixes import prefix_trie
from mesada.llm.quality import quality_rules
from mesada.llm.shard import shard
from mesada.llm.simhash import simhash_components
from mesada.llm.spm import encoding_digests
from mesada.llm.suffix import kept_digests, repeated_spans
from mesada.llm.turns import numbered, with_openings
from mesada.llm.warc import read_index, read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), folder)
    read = read_warc(read_index(spark, folder), folder, payloads=False)
    return read.select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "url",
    )


# The digits of base32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE["op2_warc"] = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, html, sha1(html) AS h FROM p),
k AS (SELECT html, max(page_id) AS original FROM p GROUP BY html)
SELECT d.page_id, CAST(strlen(d.html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
    1 + ((CAST('0x' || substr(h, CAST(1 + (i // 4) * 5 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))::INT) & 31), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN d.page_id = k.original OR k.original IS NULL THEN 'response' ELSE 'revisit' END
    AS record_type,
  CASE WHEN d.page_id <> k.original THEN k.original END AS refers_to, d.url
FROM d JOIN k ON k.html = d.html"""


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("id").alias("doc_id"), *names, "base_failed", "kept")


@query
def op5_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.withColumnRenamed("id", "doc_id")


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    made = encoding_digests(table(spark, sf_dir, "documents"), model)
    return made.withColumnRenamed("id", "doc_id")


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    return kept_digests(spans).withColumnRenamed("id", "doc_id")


# Strings are substrings of the hexadecimal text; their MD5 stands for them.
ORACLE["op8_suffix_dedup"] = """WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT r, doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
s AS (SELECT r, k, md5_number(substr(h, 2 * k + 1, 400)) AS m
  FROM (SELECT r, h, unnest(range(0, n - 199)) AS k FROM g)),
b AS (SELECT m FROM s GROUP BY m HAVING count(*) > 1),
p AS (SELECT r, k, k - lag(k) OVER (PARTITION BY r ORDER BY k) AS step FROM s SEMI JOIN b USING (m)),
q AS (SELECT r, k, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END)
  OVER (PARTITION BY r ORDER BY k) AS span FROM p),
x AS (SELECT r, span, min(k) AS a, max(k) + 200 AS z FROM q GROUP BY r, span),
e AS (SELECT r, count(*) AS n_spans, sum(z - a) AS n_removed FROM x GROUP BY r),
k AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS low, a AS high FROM x
  UNION ALL SELECT g.r, coalesce(max(x.z), 0), any_value(g.n) FROM g LEFT JOIN x USING (r) GROUP BY g.r),
t AS (SELECT k.r, string_agg(substr(g.h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS kept
  FROM k JOIN g USING (r) GROUP BY k.r)
SELECT g.doc_id, g.n AS n_bytes, CAST(coalesce(e.n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(e.n_spans, 0) AS n_spans, sha256(unhex(coalesce(t.kept, ''))) AS kept_sha256
FROM g LEFT JOIN e USING (r) JOIN t USING (r)"""


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash_components(table(spark, sf_dir, "documents"))
    return linked.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_predictions(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


ORACLE["op12_hard_negatives"] = """WITH r AS (SELECT vec_id,
  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
  CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE vec_id <> anchor_id AND label = anchor_label QUALIFY
  row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
  negative_score FROM n WHERE rank <= 10"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_openings(numbered(table(spark, sf_dir, "conversations"))))


ORACLE["op13_prefix_trie"] = """WITH t AS (SELECT conv_id, coalesce(role, '') AS role,
  coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND t.pos <= c.h) AS taken
  FROM c),
r AS (SELECT m.conv_id, t.pos AS d, t.role, t.text
  FROM m JOIN t ON t.conv_id = m.base AND t.pos <= m.h
  UNION ALL SELECT m.conv_id, t.pos - m.h + m.taken, t.role, t.text
  FROM m JOIN t ON t.conv_id = m.conv_id AND t.pos > m.h
  UNION ALL SELECT conv_id, 0, NULL, '' FROM m),
k AS (SELECT conv_id, d, length(text) AS chars, max(d) OVER (PARTITION BY conv_id) AS len,
  string_agg(CASE WHEN d > 0 THEN md5(role) || md5(text) ELSE '' END, '')
    OVER (PARTITION BY conv_id ORDER BY d) AS key FROM r),
n AS (SELECT d AS depth, key, min(conv_id) AS conv_id, count(*) AS n_convs,
  (count(*) - 1) * any_value(chars) AS saved, count(*) FILTER (d = len) = count(*) AS leaf,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = len), ''))
    AS ends_sha256 FROM k GROUP BY d, key),
u AS (SELECT DISTINCT a.key AS above, b.key, b.d AS depth
  FROM k AS a JOIN k AS b ON a.conv_id = b.conv_id AND b.d >= a.d),
s AS (SELECT u.above, count(*) FILTER (n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM u JOIN n ON n.key = u.key GROUP BY u.above)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  (SELECT count(*) FROM n AS x WHERE x.depth = n.depth + 1
    AND substr(x.key, 1, length(x.key) - 64) = n.key) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.above = n.key LEFT JOIN n AS p
  ON p.depth = n.depth - 1 AND p.key = substr(n.key, 1, greatest(length(n.key) - 64, 0))"""
