import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annualis.llm import rans
from annualis.llm.queries import END_ID, TOKENIZER_FILE


ODD = "aBé\u0301'12 \n\t\xa0\u2003\x1c\x85ß漢🙂Σςİ.,\r"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(public_tokenizers.path(TOKENIZER_FILE))
    out.encode_special_tokens = True
    return out


def expected(rows, library):
    """Documents in order, nulls first, with the place of their first token."""
    out, start = [], 0
    coded = [(i is not None, i or 0, library.encode(t or "", add_special_tokens=False).ids + [END_ID]) for i, t in rows]
    for known, i, ids in sorted(coded):
        out.append((i if known else None, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def test_written_and_read(docs, rows_of_docs, library, frame):
    out = frame(rans.document_tokens(docs, TOKENIZER_FILE, END_ID)).sort_values("start")
    want, total = expected(rows_of_docs, library)
    assert out["start"].tolist() == [0, *np.cumsum(out["n_tokens"].tolist())[:-1]]
    assert int(out["n_tokens"].sum()) == total
    got = list(zip(out["doc_id"], out["n_tokens"], out["ids_crc32"]))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_blocks_and_parts(docs, rows_of_docs, library, frame, spark, tmp_path, monkeypatch):
    """Documents over many blocks; the ids read back are those written."""
    tokens = rans.tokenize(docs, TOKENIZER_FILE, END_ID)
    monkeypatch.setattr(rans, "PART_TOKENS", 5_000)
    monkeypatch.setattr(rans, "BLOCK", 300)
    rans.write_tokens(tokens, str(tmp_path / "tokens"))
    out = frame(rans.read_tokens(spark, str(tmp_path / "tokens")))
    want, total = expected(rows_of_docs, library)
    assert sorted(zip(out["doc_id"], out["n_tokens"], out["ids_crc32"]), key=str) == sorted(want, key=str)
    ids = rans.read_ids(spark, str(tmp_path / "tokens")).orderBy("part", "first").select(F.explode("ids")).count()
    assert ids == total


def test_no_documents(no_docs, frame):
    assert frame(rans.document_tokens(no_docs, TOKENIZER_FILE, END_ID)).empty


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 20), st.integers(0, 10**6)), max_size=3_000))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.int64)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True)) if len(ids) else rans.Table(ids, ids)
    lanes, words, states, offsets = rans.encode_block(ids, table)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    assert rans.decode_block(table, len(ids), lanes, words, states, offsets, crc).tolist() == ids.tolist()
    if len(ids):
        with pytest.raises(ValueError):
            rans.decode_block(table, len(ids), lanes, words, states, offsets, crc ^ 1)


def test_decoding_from_a_checkpoint():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50, 100_000)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    lanes, words, states, offsets = rans.encode_block(ids, table)
    state = states.reshape(-1, lanes)[1]
    part, _ = rans.decode_rows(table, len(ids), lanes, words, state, rans.CHECKPOINT, int(offsets[1]), rans.CHECKPOINT + 3)
    begin = rans.CHECKPOINT * lanes
    assert (part == ids[begin:begin + 3 * lanes]).all()


def test_skewed_table_keeps_all_symbols():
    counts = np.ones(200_000, np.int64)
    counts[:5] = 10**10
    table = rans.Table.of_counts(np.arange(200_000), counts)
    assert int(table.frequency.sum()) == 1 << rans.SCALE and int(table.frequency.min()) >= 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*ODD, "'s", "<|endoftext|>", "the"]), max_size=30).map("".join))
def test_stretches_give_the_ids_of_the_text(library, text):
    got = np.frombuffer(rans.tokenizer_of(TOKENIZER_FILE).encode_all([text.encode()])[0], "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


@given(st.binary(max_size=80), st.binary(max_size=80))
def test_joined_checksums(a, b):
    assert rans.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBzéÉßñſİǅʰ'<|>12²½.,-_ ́Α漢\U0001f642"), max_size=12), max_size=8))
def test_stretches_made_of_runs(texts):
    own = rans.tokenizer_of(TOKENIZER_FILE)
    want = [np.array(own.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode_all([t.encode() for t in texts]) == want


def test_memory_is_halved(monkeypatch, library):
    monkeypatch.setattr(rans, "CACHE", 40)
    import public_tokenizers

    own = rans.WordTokenizer(public_tokenizers.path(TOKENIZER_FILE))
    for k in range(30):
        text = " ".join(f"word{j}x{j * k}," for j in range(12))
        assert own.encode_all([text.encode()]) == [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def test_plain_texts_need_no_stretches(library):
    """Plain texts are made up from runs alone, ASCII ones without normal forms; endings such as 's are plain too."""
    import public_tokenizers

    own = rans.WordTokenizer(public_tokenizers.path(TOKENIZER_FILE))
    texts = ["It's the dogs' \u00fcber-caf\u00e9,\tand they'LL (don't) ...'s 12'3 ''ve 'sore", "plain\r\nwords\x0b\x0c2024!", "<|endoftext|> 'Re", "odd \u0301 mark it's"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode_all([t.encode() for t in texts]) == want
    assert set(own.known) == {"odd".encode(), "\u0301".encode(), b"mark", b"it's"}
    assert own.lean is not own.library
    assert all(own.lean.encode(r, add_special_tokens=False).ids == own.library.encode(r, add_special_tokens=False).ids for r in own.runs if r.isascii())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aBsSttrREvemlLd''\"-.,1\u00b2\u00e9\u017f \t\n\x0b"), max_size=40))
def test_endings(library, text):
    assert np.frombuffer(rans.tokenizer_of(TOKENIZER_FILE).encode_all([text.encode()])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
