"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, extract, license, pii, quality, shard, simhash, topk, toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"))


def pseudonym_key(spark: SparkSession) -> bytes:
    """The secret of ``spark.lakewright.pseudonym.key``; for the invented tables, where none is set, a public one."""
    return spark.conf.get("spark.lakewright.pseudonym.key", "lakewright demonstration key").encode()


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_read(spark, sf_dir, "documents"), pseudonym_key(spark))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_read(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.report(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_simhash": op3_simhash,
    "op4_html": op4_html,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_license": op7_license,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_pii": op10_pii,
}

SQL: dict[str, str] = {}

_SPLIT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op6_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

SQL["op2_topk"] = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
