"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import embed_dedup, hard_negatives, html_extract, packing, pii, prefix_trie, quality, secret_scan, sentencepiece_codec, sharding, simhash, suffix_dedup, url_filter
from pairforge.llm.common import table

#: Rules of the URL filter query: (host, path) as one key, verdict.
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"),
                           quality.trusted_keys(table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "llr")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest_documents(table(spark, sf_dir, "documents"))


def url_list(spark: SparkSession) -> DataFrame:
    rows = [(k, v, "rule") for k, v in URL_RULES] + [(h + "/", "block", "list") for h in url_filter.SPAM_HOSTS]
    return spark.createDataFrame(rows, "key string, verdict string, source string")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_list(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.quantised(table(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_suffix_dedup, op3_best_fit_packing, op4_secret_scan, op5_sharding, op6_html_extraction,
                                   op7_embedding_dedup, op8_sentencepiece,
                                   op9_url_filter, op10_simhash, op11_prefix_trie, op12_pii, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    listed = ", ".join(f"('{k.partition('/')[0]}', '/{k.partition('/')[2]}', '{k}', '{v}', 1)" for k, v in URL_RULES)
    spam = ", ".join(f"('{h}', '/', '{h}/', 'block', 0)" for h in url_filter.SPAM_HOSTS)
    windows = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 99))) AS i FROM d),
m AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS m FROM w),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS n FROM m),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new
      FROM f WHERE n > 1),
k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
s AS (SELECT doc_id, k, min(i) AS s, max(i) + 100 AS e FROM k GROUP BY doc_id, k),
p AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY k), 0) AS b FROM s),
r AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans, max(e) AS last,
        string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY k) AS head FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)"""
    links = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id"""
    # crc32 by its table of 256 remainders; digests and order of turns as in the operator
    trie = """
WITH RECURSIVE steps AS (
  SELECT b::BIGINT AS b, b::BIGINT AS v, 0 AS i FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM steps WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE i = 8),
ranked AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), item) - 1 AS pos, item, words
  FROM (SELECT *, substr(sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS item,
          len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL)),
ids AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM ranked), crc),
turns AS (
  SELECT i.conv_id, 0 AS part, r.pos, r.item, r.words FROM ids i JOIN ranked r ON r.conv_id = i.base AND r.pos < i.h
  UNION ALL SELECT i.conv_id, 1, r.pos, r.item, r.words FROM ids i JOIN ranked r ON r.conv_id = i.conv_id AND r.pos >= i.h),
convs AS MATERIALIZED (
  SELECT i.conv_id, coalesce(string_agg(item, '' ORDER BY part, pos), '') AS path, list(words ORDER BY part, pos) AS w, count(item) AS n
  FROM ids i LEFT JOIN turns USING (conv_id) GROUP BY i.conv_id),
nodes AS MATERIALIZED (
  SELECT substr(path, 1, 32 * d) AS key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN w[d] ELSE 0 END) AS words,
    string_agg(CASE WHEN d = n THEN conv_id END::VARCHAR, ',' ORDER BY conv_id) AS ends
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM convs) GROUP BY 1, 2),
kids AS (SELECT substr(key, 1, 32 * (d - 1)) AS key, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
flat AS MATERIALIZED (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (key)),
sums AS (
  SELECT substr(key, 1, 32 * a) AS key, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT key, k, n_convs, words, unnest(range(d + 1)) AS a FROM flat) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.k::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM flat f JOIN sums USING (key) LEFT JOIN nodes p ON f.d > 0 AND p.key = substr(f.key, 1, 32 * (f.d - 1))"""
    # whole numbers below 2^53, so sums in doubles are exact
    mined = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3"""
    return {"op11_prefix_trie": trie, "op13_hard_negatives": mined, "op2_suffix_dedup": windows, "op7_embedding_dedup": links, "op9_url_filter": f"""
WITH listed(h, p, key, verdict, own) AS (VALUES {listed}, {spam}),
u AS (
  SELECT page_id, row_number() OVER () AS rid,
    coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT rid, arg_max(struct_pack(key := key, verdict := l.verdict, own := own), own * 1000 + length(key)) AS b
  FROM u JOIN listed l ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, CASE WHEN b.own = 1 THEN b.key END AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM u LEFT JOIN best USING (rid)"""}
