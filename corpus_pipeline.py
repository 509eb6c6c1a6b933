"""A corpus pipeline of five stages, each by one operator of ``annualis.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents.
All but the last return the columns of ``documents``. Null or empty texts, repeated rows, empty tables and
extra columns are handled as the operators' docstrings say: no stage drops a row for them but the
near-duplicate stage, which keeps one row of a repeated doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annualis.llm import lsa_decontam, prefix_bpe, repeats, simhash_vp, toxicity
from annualis.llm.common import read
from annualis.session import stored

BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under a half."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id."""
    return simhash_vp.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 bytes or more that a document with a smaller doc_id has."""
    return repeats.cut_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return lsa_decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of the ids and of the bytes decoded from them."""
    return prefix_bpe.round_trip(docs, BPE_FILE, with_ids=True)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

ORACLE_SQL = None  # fitted scores, transitive links and byte merges are beyond SQL; the tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
