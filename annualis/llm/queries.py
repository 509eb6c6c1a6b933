"""The registered queries of this package, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annualis.llm import (cover_tree, embedding_pq, hpylm, lsa_decontam, pair_alignment, pivot_search, prefix_bpe, rans, repeats, sharding, simhash_vp,
                          toxicity, url_filter)
from annualis.llm.common import read

SHARDS = 16
TOKENIZER_FILE, END_ID = "word_bpe_49k.json", 2
BPE_FILE = "byte_bpe_multi_50k.tiktoken"
BYTE_TOKENS, PIECE_TOKENS = "byte_bpe_50k", "piece_bpe_32k"


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(read(spark, sf_dir, "documents"), SHARDS)


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(read(spark, sf_dir, "documents"), BPE_FILE)


def op7_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.document_simhash(read(spark, sf_dir, "documents"))


def op8_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    judged = url_filter.judge_urls(pages, url_filter.reported_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_prefix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.document_repeats(read(spark, sf_dir, "documents"))


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsa_decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_range_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.document_tokens(read(spark, sf_dir, "documents"), TOKENIZER_FILE, END_ID)


def op2_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_pq.embedding_links(read(spark, sf_dir, "embeddings"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_documents(read(spark, sf_dir, "documents"))


def op11_pair_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_alignment.aligned_documents(read(spark, sf_dir, "documents"), BYTE_TOKENS, PIECE_TOKENS)


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.embedding_negatives(read(spark, sf_dir, "embeddings"))


def op13_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.embedding_neighbours(read(spark, sf_dir, "embeddings"), k=5, every=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_jump_shards, op2_product_quantisation, op3_range_ans, op4_pitman_yor, op5_toxicity_grammar, op6_prefix_bpe, op7_simhash_vantage, op8_url_bloom, op9_prefix_intervals, op10_latent_decontamination,
                                 op11_pair_alignment, op12_cover_tree, op13_pivot_search)
}

_RULES = " UNION ALL ".join(f"SELECT '{h}' AS rule_host, '{p}' AS rule_path, '{v}' AS rule_verdict" for h, p, v in url_filter.RULES)
_WHOLE = """SELECT vec_id, label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""
ORACLE: dict[str, str] = {
    "op12_cover_tree": f"""WITH rows AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM ({_WHOLE}) WHERE label IS NOT NULL),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT * FROM negatives WHERE rank <= 3""",
    "op13_pivot_search": f"""WITH rows AS ({_WHOLE}),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5""",
    "op8_url_bloom": f"""WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
canon AS (SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/$', '') AS entry FROM parts),
listed AS (SELECT DISTINCT entry FROM canon WHERE regexp_matches(host, '{url_filter.LISTED_SITES}')),
rules AS ({_RULES}),
ruled AS (SELECT c.page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM canon c JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY c.page_id)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN entry IN (SELECT entry FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM canon LEFT JOIN ruled USING (page_id)""",
}
