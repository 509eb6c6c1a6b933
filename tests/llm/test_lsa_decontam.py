import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from annualis.llm import lsa_decontam
from annualis.llm.tokens import PARTING, joined, unit_hashes, word_hashes
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def planted(spark):
    """Documents with whole items, changed items, items in other case, and parts too small to count."""
    rng = random.Random(11)
    items = [sentence(rng, rng.randint(15, 60)) for _ in range(30)]
    docs, leaks = [], set()
    for k in range(240):
        text = sentence(rng, rng.randint(5, 400))
        if k % 6 == 0:
            item = k % 30
            words = items[item].split()
            if k % 4 == 0:
                words = [w if rng.random() > 0.08 else "other" for w in words]
            if k % 4 == 2:
                words = [w.upper() + "," for w in words]
            body = text.split()
            at = rng.randint(0, len(body))
            text = " ".join(body[:at] + words + body[at:])
            leaks.add((k, item))
        elif k % 6 == 1:
            text += " " + " ".join(items[k % 30].split()[:4])
        docs.append((k, text, "x"))
    docs += [(k, items[3] + " " + sentence(rng, 3), "x") for k in range(1_000, 1_150)]
    leaks |= {(k, 3) for k in range(1_000, 1_150)}
    docs += [(None, items[4], "x"), (5_000, None, "x"), (5_001, "", "x"), (5_002, sentence(rng, 5_000) + " " + items[5], "x"), (5_002, items[5], "x")]
    leaks |= {(None, 4), (5_002, 5)}
    bench = [(i, t, "y") for i, t in enumerate(items)] + [(90, None, "y"), (91, "", "y"), (92, "too few words", "y"), (93, items[6], "y"), (None, "", "y")]
    return spark.createDataFrame(docs, "doc_id long, text string, gone string").repartition(3), spark.createDataFrame(bench, "item_id long, text string, words string"), leaks


def test_planted_items_are_found_and_nothing_else(planted):
    docs, bench, leaks = planted
    out = lsa_decontam.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == leaks
    assert all(r["share"] >= 0.5 and r["cosine"] >= lsa_decontam.NEAR for r in out)


def test_in_turns(planted, monkeypatch):
    docs, bench, leaks = planted
    monkeypatch.setattr(lsa_decontam, "ITEMS", 8)
    assert {(r["doc_id"], r["item_id"]) for r in lsa_decontam.find_leaks(docs, bench).collect()} == leaks


def test_clean_documents_stay(planted):
    docs, bench, leaks = planted
    kept = lsa_decontam.keep_clean(docs, bench)
    gone = {i for i, _ in leaks}
    want = [r["doc_id"] for r in docs.collect() if r["doc_id"] not in gone]
    assert kept.columns == docs.columns and sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))


def test_the_text_of_a_row_decides_not_its_id(spark, planted):
    _, bench, _ = planted
    item = bench.filter("item_id = 7").first()["text"]
    rows = [(1, "clean words here"), (1, item), (None, "clean too"), (None, item), (2, None), (None, None)]
    kept = lsa_decontam.keep_clean(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([rows[0], rows[2], rows[4], rows[5]], kept.schema).collect()))


def test_short_items_and_items_without_spaces(spark):
    """Word for word wherever they stand, unless they have under three words: then as a whole text only."""
    chinese = "量子力学描述了微观世界中粒子的行为以及它们之间的相互作用,是现代物理学的重要基础之一"
    bench = [(1, "Yes"), (2, "blue moon"), (3, "seven red foxes"), (4, "a b c d"), (5, "one day the old clock stopped"),
             (6, chinese), (7, "人工智能"), (8, "ภาษาไทยง่าย"), (9, "?!")]
    texts = ["yes", "Yes, indeed", "blue moon!", "the blue moon rose", "I saw SEVEN red foxes.", "seven big red foxes", "x a b c d y", "a b x c d",
             "then one day the old clock stopped again", "前言" + chinese + "后记", "word " + chinese, "关于人工智能的讨论", "人工 智能", "เรียนภาษาไทยง่ายมาก",
             "", "?!", None, "你好,世界"]
    found = lsa_decontam.find_leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                    spark.createDataFrame(bench, "item_id long, text string")).collect()
    # The last character of a long item stands beside another one in document 9.
    pairs = {(r["doc_id"], r["item_id"]) for r in found if r["share"] > 0.95}
    assert pairs == {(0, 1), (2, 2), (4, 3), (6, 4), (8, 5), (9, 6), (10, 6), (11, 7), (13, 8)}
    # In other words only what the share allows.
    assert {(r["doc_id"], r["item_id"]) for r in found} - pairs <= {(12, 7)}


def _in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, last = [0], row
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_against_every_pair_of_window_and_item(planted):
    """All windows and items by the plain rule, without the latent space."""
    docs, bench, _ = planted
    items = {r["item_id"]: r["text"].lower().split() for r in bench.collect() if r["text"] and len(r["text"].split()) >= 5}
    in_items = {i: set(w) for i, w in items.items()}
    want = set()
    for r in docs.filter("doc_id < 240").collect():
        words = r["text"].lower().replace(",", "").split()
        for i, item in items.items():
            for place in range(0, len(words), lsa_decontam.SEGMENT):
                region = words[max(0, place - len(item)):place + lsa_decontam.PASSAGE + len(item)]
                if len(in_items[i] & set(region)) < 0.5 * len(in_items[i]):
                    continue
                share = _in_order(item, region) / len(item)
                if share >= 0.8 or (share >= 0.5 and _in_order(item[-8:], region) >= 0.75 * 8):
                    want.add((r["doc_id"], min(j for j in items if items[j] == item)))
                    break
    got = {(r["doc_id"], r["item_id"]) for r in lsa_decontam.find_leaks(docs, bench).collect() if r["doc_id"] is not None and r["doc_id"] < 240}
    assert got == want and len(want) >= 40


def test_exact_items_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["item_id"]: r["text"] for r in bench.collect()}
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if t in r["text"]}
    found = {(r["doc_id"], r["item_id"]) for r in lsa_decontam.find_leaks(docs, bench).collect()}
    assert exact and exact <= found and len(found - exact) <= 0.05 * len(exact)


def test_empty_tables(planted):
    docs, bench, _ = planted
    assert lsa_decontam.find_leaks(docs.filter("false"), bench).count() == 0
    assert lsa_decontam.find_leaks(docs, bench.filter("false")).count() == 0
    assert lsa_decontam.find_leaks(docs, bench.filter("item_id = 92")).count() == 0


@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
def test_common_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    assert lsa_decontam.common_subsequence(a, b) == table[-1, -1]


def test_products_and_singular_vectors():
    """The products with sparse rows are those of the dense matrix, and the space holds its largest directions."""
    rng = np.random.default_rng(0)
    numbers, slot = rng.integers(0, 30, 2_000), np.sort(rng.integers(0, 90, 2_000))
    weights = np.r_[0, rng.uniform(1, 3, 29)]
    passage, term, value = lsa_decontam.tfidf(numbers, slot, weights)
    dense = np.zeros((passage.max() + 1, 30))
    dense[passage, term] = value
    assert np.allclose(np.linalg.norm(dense, axis=1), 1) and (dense[:, 0] == 0).all()
    m = rng.normal(size=(30, 5))
    out = np.zeros((30, 5))
    lsa_decontam.gram_product(passage, term, value, m, out)
    assert np.allclose(out, dense.T @ (dense @ m))


def test_sums_of_rows():
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(50, 7))
    for sizes in ([], [1], [0, 3, 0, 200], list(rng.integers(0, 9, 1_500)), [70, 1] * 600):
        group = np.repeat(np.arange(len(sizes)), np.array(sizes, int))
        of, value = rng.integers(0, 50, len(group)), rng.normal(size=len(group))
        want = np.zeros((int(group[-1]) + 1 if len(group) else 0, 7))
        np.add.at(want, group, matrix[of] * value[:, None])
        assert np.allclose(lsa_decontam.sum_rows(matrix, of, group, value), want)
        want[:] = 0
        np.add.at(want, group, matrix[of])
        assert np.allclose(lsa_decontam.sum_rows(matrix, of, group), want)


def _units(text):
    data, _ = joined([text.encode()])
    starts, hashes, alone = unit_hashes(data, PARTING)
    return starts.tolist(), hashes.tolist(), alone.tolist()


def test_units_of_scripts_with_and_without_spaces():
    starts, hashes, alone = _units("Über 漢字 x漢y、字。Ａ")
    assert len(starts) == 8 and alone == [False, False, True, False, True, False, True, True]
    data, _ = joined(["Über straße naïve".encode()])
    assert _units("Über straße naïve")[1] == word_hashes(data, PARTING, fold_latin=True)[1].tolist()
    inner = _units("前漢字文後")[1]
    assert inner[1:3] == _units("漢字文")[1][:2] and inner[3] != _units("漢字文")[1][2]
    assert _units("漢")[0] == [0] and _units("")[0] == []
