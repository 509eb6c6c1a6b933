import hashlib

import numpy as np

import __spark_entry__
import corpus_pipeline
from annualis.llm import queries, toxicity
from tests.llm.test_repeats import mask_by_definition
from tests.llm.test_simhash_vp import expected as simhash_expected


def test_stages_one_by_one(spark, sf_dir):
    """Each stage's rows by brute force from what the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    run = dict(corpus_pipeline.STAGES)
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    clean = run["toxicity"](spark, docs, sf_dir)
    scores = {r["doc_id"]: r["score"] for r in toxicity.document_toxicity(docs, labels).collect()}
    assert sorted(rows(clean)) == sorted(r for r in rows(docs) if scores[r[0]] < 0.5)

    single = run["near_duplicates"](spark, clean, sf_dir)
    want = {i for i, _, c in simhash_expected(rows(clean)) if i == c}
    assert sorted(rows(single)) == sorted(r for r in rows(clean) if r[0] in want)

    cut = run["repeated_passages"](spark, single, sf_dir)
    sizes = {i: int((~gone).sum()) for i, _, gone in mask_by_definition(rows(single))}
    got = dict(rows(cut))
    assert got.keys() == sizes.keys() and all(0 <= len(got[i].encode()) - n <= 16 for i, n in sizes.items())

    left = run["benchmark_leaks"](spark, cut, sf_dir)
    texts = [r["text"] for r in bench.collect()]
    leaking = {i for i, t in rows(cut) if any(b in t for b in texts)}
    ids = {i for i, _ in rows(left)}
    assert not ids & leaking and len(ids) >= 0.97 * (len(got) - len(leaking))
    for stage in (clean, single, cut, left):
        assert sorted(stage.columns) == sorted(docs.columns)

    final = run["token_ids"](spark, left, sf_dir)
    texts = dict(rows(left))
    for r in final.collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["n_tokens"] == len(np.frombuffer(r["ids"], "<u4"))


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and 0 < out.count() <= 200


def test_odd_rows_pass_all_stages(spark, docs, no_docs, sf_dir):
    for table in (docs, no_docs):
        df = table
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf_dir)
        assert (df.count() > 0) == (table is docs)


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
