import zlib

from annualis.llm import sharding


def jump_by_definition(key, shards):
    at, to, key = -1, 0, key % 2**64
    while to < shards:
        at, key = to, (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_shards_slots_and_growth(docs, rows_of_docs, frame):
    out = frame(sharding.document_shards(docs, 16))
    assert len(out) == len(rows_of_docs)
    facts = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of_docs)
    assert facts == sorted((i is not None, i or 0, n, c) for i, n, c in zip(out["doc_id"], out["size"], out["text_crc32"]))
    for doc_id, shard, grown in zip(out["doc_id"], out["shard"], out["grown_shard"]):
        assert shard == jump_by_definition(doc_id or 0, 16) and grown == jump_by_definition(doc_id or 0, 17)
        assert grown in (shard, 16)
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert set(out["law"]) == {"key"}


def test_slots_over_many_runs(docs, frame, monkeypatch):
    whole = frame(sharding.document_shards(docs, 3))
    monkeypatch.setattr(sharding, "RUN_ROWS", 5)
    out = frame(sharding.document_shards(docs, 3))
    assert sorted(zip(map(str, out["doc_id"]), out["shard"])) == sorted(zip(map(str, whole["doc_id"]), whole["shard"]))
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def test_other_keys_and_no_rows(docs, no_docs, frame):
    by_text = frame(sharding.assign_shards(docs.select("text", "slot"), ["text"], 4, ["text"]))
    assert by_text.groupby(by_text["text"].map(str))["shard"].nunique().max() == 1
    assert by_text["slot"].map(type).eq(int).all()
    assert frame(sharding.document_shards(no_docs, 16)).empty


def test_written_shards(docs, spark, tmp_path):
    sharding.write_shards(docs.drop("shard"), ["doc_id"], 4, str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert read.count() == docs.count()
    assert all(jump_by_definition(r["doc_id"] or 0, 4) == r["shard"] for r in read.select("doc_id", "shard").collect())
