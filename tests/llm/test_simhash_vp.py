import numpy as np
import pytest
import xxhash

from annualis.llm import simhash_vp
from annualis.llm.common import connected_components, merge_labels


def by_definition(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k:k + 4]), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = np.array([by_definition(t) for _, t in rows], np.uint64)
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= simhash_vp.MOST_APART)
    label = merge_labels(np.arange(len(rows)), i, j)
    lowest = {}
    for (doc_id, _), k in zip(rows, label):
        if doc_id is not None:
            lowest[k] = min(doc_id, lowest.get(k, doc_id))
    return [(i, f"{p:016x}", lowest.get(k)) for (i, _), p, k in zip(rows, prints.tolist(), label)]


def test_fingerprints_and_components(docs, rows_of_docs, frame):
    out = frame(simhash_vp.document_simhash(docs))
    assert sorted(zip(out["doc_id"], out["fingerprint"], out["component_id"]), key=str) == sorted(expected(rows_of_docs), key=str)


def test_given_documents(spark, sf_dir, frame):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    out = frame(simhash_vp.document_simhash(table))
    assert sorted(zip(out["doc_id"], out["fingerprint"], out["component_id"])) == sorted(expected(rows))


def test_shingles_of_the_spark_hash(spark):
    row = spark.sql("select xxhash64('a b c d') as h").first()
    assert np.uint64(row["h"] % 2**64) == simhash_vp.fingerprint(b"A b\tc\nd")


def test_one_of_each_group_stays(docs, rows_of_docs, frame):
    kept = frame(simhash_vp.keep_first(docs))
    assert list(kept.columns) == docs.columns
    want = {i for i, _, c in expected(rows_of_docs) if i is not None and i == c}
    ids = [i for i in kept["doc_id"] if i is not None]
    assert sorted(ids) == sorted(want) and kept["doc_id"].isna().sum() == sum(i is None for i, _ in rows_of_docs)


def test_no_documents(no_docs, frame):
    assert frame(simhash_vp.document_simhash(no_docs)).empty and frame(simhash_vp.keep_first(no_docs)).empty


@pytest.mark.parametrize("points, radius", [(1, 8), (40, 20), (300, 24), (300, 31)])
def test_every_close_pair_is_asked(points, radius):
    rng = np.random.default_rng(points)
    base = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    flips = np.zeros(800, np.uint64)
    for _ in range(4):
        flips ^= np.where(rng.random(800) < 0.9, np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64), np.uint64(0))
    prints = np.unique(np.concatenate([base, base ^ flips]))
    home, probes = simhash_vp.home_and_probes(prints, base[:points], radius)
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    assert len(i) > len(prints) and (probes[i, home[j]] | probes[j, home[i]]).all()


def test_blocks_and_turns(docs, rows_of_docs, frame, monkeypatch):
    monkeypatch.setattr(simhash_vp, "MEMBERS", 4)
    monkeypatch.setattr(simhash_vp, "ASKING", 9)
    out = frame(simhash_vp.document_simhash(docs))
    assert sorted(zip(out["doc_id"], out["fingerprint"], out["component_id"]), key=str) == sorted(expected(rows_of_docs), key=str)


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = np.random.default_rng(0)
    edges = [(k, k + 1) for k in range(200)] + [(1_000, 1_001 + k) for k in range(300)] + [(9_000 - k, 9_001 - k) for k in range(100)]
    edges += [(int(a), int(b)) for a, b in rng.integers(20_000, 20_400, (300, 2))] + [(5, 5)]
    nodes = np.unique(np.array(edges))
    at = {n: k for k, n in enumerate(nodes.tolist())}
    label = merge_labels(np.arange(len(nodes)), np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: int(nodes[label[at[n]]]) for n in linked}
