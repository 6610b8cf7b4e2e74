"""The registered queries of this subpackage, and SQL for those whose rows SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import (align, audit, decontam, fingerprint, jaccard, mixture, neardup, quality, secretscan, shards,
                            substrings, urlfilter, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents")).drop("edited")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans", "items")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (mix["copies"] * mix["size"]).alias("taken"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(_table(spark, sf_dir, "documents")).drop("kept_text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(_table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_sharding, op3_minhash_dedup, op4_warc, op5_fingerprint,
    op6_url_filter, op7_decontamination, op8_quality, op9_mixing, op10_substring_dedup,
    op11_filter_audit, op12_token_alignment, op13_jaccard_join)}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(width: int) -> str:
    """Documents, the sizes of their shingle sets, and the smallest doc_id that links of 0.8 reach."""
    return rf"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOW}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < {width} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {width} - 1], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width} + 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, root AS component_id
FROM documents d JOIN roots ON roots.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""


OP3 = f"SELECT *, doc_id = component_id AS kept FROM ({_components(4)})"
OP13 = _components(5)

OP4 = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
base32 AS (
  SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, (j // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (j % 8))::BIGINT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest
  FROM digests),
firsts AS (SELECT payload_digest, max(page_id) AS first FROM base32 GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM base32 JOIN firsts USING (payload_digest)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP7 = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOW}, '{_ALNUM}') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
lengths AS (SELECT DISTINCT n FROM phrases),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM places, lengths WHERE i + n - 1 <= len(w)),
found AS (SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows SEMI JOIN repeated USING (s)),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

OP11 = r"""
WITH copies AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first FROM documents GROUP BY 1),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, first
  FROM (SELECT *, coalesce(text, '') AS t FROM documents) JOIN copies USING (t)),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(first < doc_id, false)::INT AS mask,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts LEFT JOIN marks USING (doc_id)),
counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM failed GROUP BY part, mask),
letters AS (SELECT unnest(range(0, 5)) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (
  SELECT list_aggregate(list_transform(ks, lambda k: substr('ABCDE', k + 1, 1)), 'string_agg', '') AS filter_order, step,
    1 << ks[step] AS bit, coalesce(list_sum(list_transform(ks[1:step - 1], lambda k: 1 << k)), 0)::INT AS earlier
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
applied AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM applied
"""

ORACLES = {"op3_minhash_dedup": OP3, "op4_warc": OP4, "op7_decontamination": OP7, "op10_substring_dedup": OP10,
           "op11_filter_audit": OP11, "op13_jaccard_join": OP13}
