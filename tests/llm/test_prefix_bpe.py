import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annualis.llm import prefix_bpe
from annualis.llm.queries import BPE_FILE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(BPE_FILE), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return prefix_bpe.load_vocabulary(prefix_bpe.vocabulary_file(BPE_FILE)[0])


def test_ids_of_the_library_and_back(docs, rows_of_docs, library, frame):
    out = frame(prefix_bpe.round_trip(docs, BPE_FILE, with_ids=True))
    want = []
    for i, t in rows_of_docs:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(zip(*[out[c] for c in out.columns]), key=str) == sorted(want, key=str)


def test_encode_and_decode_apart(docs, rows_of_docs, frame):
    decoded = frame(prefix_bpe.decode_documents(prefix_bpe.encode_documents(docs, BPE_FILE), BPE_FILE))
    assert sorted(zip(decoded["doc_id"], map(bytes, decoded["data"])), key=str) == sorted(((i, (t or "").encode()) for i, t in rows_of_docs), key=str)


def test_no_documents(no_docs, frame):
    assert frame(prefix_bpe.round_trip(no_docs, BPE_FILE)).empty


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_texts(library, text):
    encoder = prefix_bpe.text_encoder(*prefix_bpe.vocabulary_file(BPE_FILE))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list(b"abcdeinrst \xc3\xa9\xb6\xff\x00")), min_size=1, max_size=60))
def test_bytes(vocabulary, library, data):
    data = bytes(data)
    assert vocabulary.encode(data) == library._core_bpe.encode_single_piece(data)


def test_appends_and_edits(vocabulary):
    rng = random.Random(1)
    draw = lambda n: bytes(rng.choice(b"abcdeinrst  \xc3\xa9") for _ in range(n))
    for _ in range(200):
        table = prefix_bpe.PrefixTable(vocabulary, draw(rng.randint(0, 40)))
        for _ in range(6):
            if rng.random() < 0.4:
                table.append(draw(rng.randint(0, 9)))
            else:
                a, b = sorted(rng.randint(0, len(table.data)) for _ in range(2))
                table.replace(a, b, draw(rng.randint(0, 6)))
            fresh = prefix_bpe.PrefixTable(vocabulary, table.data)
            assert table.last == fresh.last and vocabulary.decode(table.ids()) == table.data


def test_an_edit_computes_little_anew(vocabulary):
    text = b"the quick brown fox jumps over the lazy dog and runs " * 200
    table = prefix_bpe.PrefixTable(vocabulary, text)
    assert table.replace(5_000, 5_003, b"cat") < 200
    assert table.last == prefix_bpe.PrefixTable(vocabulary, table.data).last


def test_sorted_strings_share_prefixes(vocabulary, library, monkeypatch):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(["th", "an", "er", "ing", "wh", "\u00e9"]) for _ in range(6)).encode() for _ in range(2_000)})
    computed, extend = [], prefix_bpe.Vocabulary.extend
    monkeypatch.setattr(prefix_bpe.Vocabulary, "extend", lambda self, data, last, nodes: (computed.append(len(data) - len(last) + 1), extend(self, data, last, nodes)))
    assert vocabulary.encode_sorted(words) == [library._core_bpe.encode_single_piece(w) for w in words]
    assert sum(computed) < 0.5 * sum(map(len, words))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aB's re1\u00b2\u00e9 \t\n\x1c\x1f\x85\xa0.-]^"), st.characters(max_codepoint=0x24F)), max_size=40))
def test_cut_of_common_texts(text):
    encoder = prefix_bpe.text_encoder(*prefix_bpe.vocabulary_file(BPE_FILE))
    assert encoder.common != encoder.cut and not prefix_bpe.BEYOND(text)
    assert encoder.common(text) == encoder.cut(text)


def test_patterns_without_a_common_form():
    assert prefix_bpe.common_cut(r"(?i:'s)|\p{L}+") is None and prefix_bpe.common_cut(r"\w+|\s") is None
    assert prefix_bpe.BEYOND("a\u0250")


def test_memory_is_halved(monkeypatch, library):
    monkeypatch.setattr(prefix_bpe, "CACHE", 40)
    monkeypatch.setattr(prefix_bpe, "CHARACTERS", 50)
    path, pattern = prefix_bpe.vocabulary_file(BPE_FILE)
    encoder = prefix_bpe.TextEncoder(prefix_bpe.load_vocabulary(path), pattern)
    texts = [" ".join(f"word{j}x{j * k}," for j in range(k % 5)) for k in range(60)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts)] == [library.encode_ordinary(t) for t in texts]
