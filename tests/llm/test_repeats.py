import hashlib
import random

import numpy as np
import pytest

from annualis.llm import repeats


def mask_by_definition(rows):
    """(id, text, removed bytes) of each row; a null id is the largest."""
    order = lambda i: repeats.NO_ID if i is None else i
    first, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for k in range(len(t) - 49):
            span = t[k:k + 50]
            first[span] = min(order(i), first.get(span, repeats.NO_ID))
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < order(i):
                gone[k:k + 50] = True
        out.append((i, t, gone))
    return out


def facts(rows):
    out = []
    for i, t, gone in mask_by_definition(rows):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int(np.sum(np.diff(np.concatenate([[False], gone]).astype(int)) == 1))
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=str)


def test_against_definition(docs, rows_of_docs):
    assert collected(repeats.document_repeats(docs)) == facts(rows_of_docs)


def test_given_documents_in_many_blocks(spark, sf_dir, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 40_000)
    assert collected(repeats.document_repeats(table)) == facts([(r["doc_id"], r["text"]) for r in table.collect()])


def test_hot_anchors_are_dealt_by_spans(spark, sf_dir, docs, rows_of_docs, monkeypatch):
    """Every anchor with two stretches counts as hot."""
    monkeypatch.setattr(repeats, "HOT", 1)
    assert collected(repeats.document_repeats(docs)) == facts(rows_of_docs)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 60_000)
    assert collected(repeats.document_repeats(table)) == facts([(r["doc_id"], r["text"]) for r in table.collect()])


def test_texts_after_cutting(docs, rows_of_docs, frame):
    out = frame(repeats.cut_repeats(docs))
    assert list(out.columns) == docs.columns and len(out) == len(rows_of_docs)
    want = []
    for (i, text), (_, t, gone) in zip(rows_of_docs, mask_by_definition(rows_of_docs)):
        at, kept = 0, []
        for c in text or "":
            n = len(c.encode())
            if not gone[at:at + n].all():
                kept.append(c)
            at += n
        kept = None if text is None else "".join(kept)
        want.append((i, kept, None if kept is None else len(kept), "digest"))
    assert sorted(zip(out["doc_id"], out["text"], out["n_chars"], out["digest"]), key=str) == sorted(want, key=str)


def test_no_documents(no_docs, frame):
    assert frame(repeats.document_repeats(no_docs)).empty and frame(repeats.cut_repeats(no_docs)).empty


@pytest.mark.parametrize("seed", range(4))
def test_lowest_ids_of_random_stretches(seed):
    """Stretches cut from few letters, many of them alike."""
    rng = random.Random(seed)
    pool = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(3)]
    parts = [(rng.choice(pool) + bytes(rng.choice(b"ab") for _ in range(24)))[:rng.randint(50, 84)] for _ in range(60)]
    ids = np.array([rng.randint(0, 40) for _ in parts])
    count = np.array([len(p) - 49 for p in parts])
    begin = np.cumsum([0, *[len(p) for p in parts[:-1]]])
    best = repeats.lowest_ids(np.frombuffer(b"".join(parts), np.uint8), begin, count, ids)
    low = {}
    for i, p in zip(ids.tolist(), parts):
        for k in range(len(p) - 49):
            low[p[k:k + 50]] = min(i, low.get(p[k:k + 50], i))
    assert best.tolist() == [low[p[k:k + 50]] for p in parts for k in range(len(p) - 49)]


def test_maximal_repeats_by_definition():
    """Every string of 50 bytes or more that occurs twice with different bytes before and after its uses, with all of them."""
    rng = random.Random(7)
    pool = [bytes(rng.choice(b"abc") for _ in range(70)) for _ in range(4)]
    parts = [(bytes([rng.choice(b"abc")]) + rng.choice(pool)[rng.randint(0, 9):] + bytes(rng.choice(b"abc") for _ in range(5)))[:84] for _ in range(25)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    begin = np.cumsum([0, *[len(p) for p in parts[:-1]]])
    count = np.array([len(p) - 49 for p in parts])
    starts = repeats.ranges(begin, count)
    owner = np.repeat(np.arange(len(parts)), count)
    order, prefix = repeats.suffix_array(data, starts, (begin + count + 49)[owner] - starts)
    at = starts[order]
    inner = at > begin[owner[order]]
    before = np.where(inner, data[at - 1].astype(int), -1 - np.arange(len(at)))
    got = {(bytes(data[at[a]:at[a] + n]), tuple(sorted(at[a:b + 1].tolist()))) for a, b, n in repeats.maximal_repeats(prefix, before).tolist()}
    uses = {}
    for p, b in zip(parts, begin.tolist()):
        for k in range(len(p) - 49):
            for n in range(50, len(p) - k + 1):
                uses.setdefault(p[k:k + n], []).append((b + k, p[k - 1] if k else -b - 1, p[k + n] if k + n < len(p) else -b - 1))
    want = {(s, tuple(sorted(u[0] for u in us))) for s, us in uses.items()
            if len(us) > 1 and len({u[1] for u in us}) > 1 and len({u[2] for u in us}) > 1}
    assert got == want


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcdef ") for _ in range(3_000))
    pack = next(iter(repeats._pack(1)([__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, text[500:900] + b"x" * 60]})]))).column(3).to_pylist()
    whole = repeats.Block(pack)
    monkeypatch.setattr(repeats, "PIECE", 200)
    cut = repeats.Block(pack)
    spans = lambda b: np.repeat(b.hash, b.count).tolist()
    assert spans(whole) == spans(cut) and whole.count.sum() == cut.count.sum()
