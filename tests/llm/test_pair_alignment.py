import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from annualis.llm import pair_alignment
from annualis.llm.pair_alignment import MARK, PairTable, TwoTokenizers, aligned_documents, minimal_hash, pair_counts, stretches, tokenizers_of

A, B = "byte_bpe_50k", "piece_bpe_32k"
PARTS = ["word", "Don't", "it's'", "x=5;", "café", "漢字", "\U0001f642", "▁", " ", "　", "\r\n", "\n", "\n\n", "\t", "  ", "   ", " ", "!!'", "'re", "5a6", "<|endoftext|>",
         "<s>", "<0x0A>", "\x00", "\x1c", "é", "ﬁ", "ẞ", "ไทย", ");", "''s", "--", "A", "aB", "ß.", "\x0b", "\x0c", ".\r", "Δx", "Ꟃ", "​"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def plain_pair():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path(f"{A}.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=P.path(f"{B}.model"))


def spans(tokens):
    out, at = [], 0
    for token in tokens:
        out.append((at, at + len(token)))
        at += len(token)
    return out


def expected(texts):
    """Every document by the two libraries on its whole text, token by token."""
    first, second = plain_pair()
    own = tokenizers_of(A, B)
    facts, counts = [], Counter()
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        x, y = [own.byte_tokens[i] for i in a], [own.piece_tokens[i] for i in b]
        if not text or not b"".join(x) == b"".join(y) == (" " + text).encode():
            facts.append(None)
            continue
        xs, ys, links, near = spans(x), spans(y), [], 0
        for i, (s, e) in enumerate(xs):
            while near < len(ys) and ys[near][1] <= s:
                near += 1
            links += [(a[i], b[j]) for j, (u, v) in enumerate(ys[near:near + e - s + 1], near) if s < v and u < e]
        ends = {e for _, e in xs} & {e for _, e in ys}
        groups, k, m = [], 0, 0
        for end in sorted(ends):
            left, right = [], []
            while k < len(xs) and xs[k][1] <= end:
                left.append(str(a[k]))
                k += 1
            while m < len(ys) and ys[m][1] <= end:
                right.append(str(b[m]))
                m += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        facts.append((len(a), len(b), groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for f in facts:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, counts


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(found, ids, texts):
    out, _ = expected(texts)
    assert sorted(((r["doc_id"], *[r[c] for c in FIELDS]) for r in found.collect()), key=str) == sorted(((i, *o) for i, o in zip(ids, out)), key=str)


def test_all_documents(docs, rows_of_docs):
    same(aligned_documents(docs, A, B), [i for i, _ in rows_of_docs], [t or "" for _, t in rows_of_docs])


def test_odd_texts_in_many_batches_and_chunks(spark, monkeypatch):
    texts = odd_texts(400, 1)
    monkeypatch.setattr(pair_alignment, "BYTES", 2_000)
    monkeypatch.setattr(pair_alignment, "BUCKET_KEYS", 200)
    monkeypatch.setattr(pair_alignment, "CHUNK", 400)
    monkeypatch.setattr(pair_alignment, "CACHE", 300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = aligned_documents(df, A, B, with_groups=True)
    same(found, range(len(texts)), texts)
    for r in found.limit(50).collect():
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")


def test_pair_counts(spark):
    texts = odd_texts(200, 2) + ["the same text"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["a_id"], r["b_id"]): r["n_docs"] for r in pair_counts(df, A, B).collect()}
    assert found == dict(expected(texts)[1])


def test_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    same(aligned_documents(df, A, B), [r[0] for r in rows], [r[1] or "" for r in rows])


def test_nothing(spark, no_docs):
    assert aligned_documents(no_docs, A, B).count() == 0
    df = spark.createDataFrame([(None, None), (1, ""), (1, MARK)], "doc_id long, text string")
    assert sorted(tuple(r) for r in aligned_documents(df, A, B).select(*FIELDS).collect()) == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_stretches_make_up_the_text():
    for text in odd_texts(3_000, 3):
        assert "".join(stretches(" " + text)) == " " + text


def test_pieces_over_a_border_are_refused():
    own = tokenizers_of(A, B)

    class Odd:
        def id_to_piece(self, n):
            return "a" + MARK

        is_byte = is_control = is_unknown = staticmethod(lambda n: False)

    odd = TwoTokenizers.__new__(TwoTokenizers)
    odd.by_pieces = Odd()
    with pytest.raises(ValueError):
        odd._piece(0)
    assert own.piece_tokens[3:259] == [bytes([n]) for n in range(256)]


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5_000, 40_000])
def test_minimal_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    sizes, slots, names = minimal_hash(keys)
    assert np.array_equal(np.sort(names), keys) and np.array_equal(np.sort(slots[slots >= 0]), np.arange(len(keys)))
    pack = pair_alignment._squeeze
    table = PairTable([{"bucket": 0, "n": len(keys), "sizes": pack(sizes), "slots": pack(slots), "keys": pack(names)}], 1)
    assert np.array_equal(table.keys[table.find(keys)], keys)
    others = np.setdiff1d(np.arange(1_000) * 977, keys)
    assert (table.find(others) == -1).all()
