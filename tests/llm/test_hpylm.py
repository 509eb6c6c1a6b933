import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from annualis.llm import hpylm


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def expected(rows):
    """Counts and base scores by definition."""
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    seen = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    out = []
    for (i, t), h in zip(rows, held):
        words = tokens(t)
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((i, h, len(words), sum(w in seen for w in words), n, base))
    return sorted(out, key=str)


def test_counts_and_base_scores(docs, rows_of_docs, frame):
    out = frame(hpylm.score_documents(docs))
    got = zip(out["doc_id"], out["held_out"], out["n_tokens"], out["n_known"], out["train_tokens"], out["base_score"])
    for own, want in zip(sorted(got, key=str), expected(rows_of_docs), strict=True):
        assert own[:5] == want[:5] and abs(own[5] - want[5]) < 1e-6
    assert (out["score"].astype(float) < 0).all() and np.isfinite(out["score"].astype(float)).all()


def test_same_scores_again_and_in_small_parts(docs, frame, monkeypatch):
    key = ["n_tokens", "base_score", "score"]
    once, twice = (frame(hpylm.score_documents(docs)).sort_values(key) for _ in range(2))
    assert once["score"].tolist() == twice["score"].tolist()
    monkeypatch.setattr(hpylm, "PART_TOKENS", 2_000)
    parts = frame(hpylm.score_documents(docs))
    total = lambda f: float(f["score"].astype(float).sum())
    assert abs(total(parts) / total(once) - 1) < 0.01
    assert abs(float(parts["base_score"].astype(float).sum()) - float(once["base_score"].astype(float).sum())) < 1e-4


def test_better_than_the_base_on_held_out_texts(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["held_out"]: r for r in hpylm.perplexity(hpylm.score_documents(docs)).collect()}
    assert rows[True]["perplexity"] < rows[True]["base_perplexity"]
    assert rows[False]["perplexity"] < rows[True]["perplexity"]


def test_no_documents_and_nothing_to_learn(docs, no_docs, frame):
    assert frame(hpylm.score_documents(no_docs)).empty
    held = docs.filter(hpylm.held_out_fold(docs["doc_id"], 1))
    out = frame(hpylm.score_documents(held))
    assert set(out["train_tokens"]) == {0} and set(out["n_known"]) == {0} and len(out) == held.count()


@pytest.fixture(scope="module")
def small():
    """One part's cells of a random corpus, after some sweeps."""
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(10, 1 << 62, 40, dtype=np.uint64))
    uses = rng.zipf(1.5, (40, 12)).clip(0, 300)
    uses[rng.random(uses.shape) < 0.5] = 0
    uses[:, 0] += 1
    sizes = (uses > 0).sum(axis=1).astype(np.uint32)
    rooms = np.concatenate([np.flatnonzero(u) for u in uses]).astype(np.uint16)
    types = hpylm._squeeze(words, sizes, rooms, uses[uses > 0].astype(np.uint32))
    seated = np.zeros(hpylm.RESTAURANTS)
    seated[:12] = uses.sum(axis=0)
    plan = hpylm.Plan(np.zeros(0, np.uint64), np.zeros(0), seated, int(uses.sum()), 40, 0.6, 0.5)
    cells = hpylm.Cells(types, plan, 0)
    state = lambda: hpylm.State(cells.totals()[:hpylm.RESTAURANTS], float(cells.own.sum()), float(cells.root_tables.sum()), np.zeros(0), np.zeros(0))
    plan.states.append(state())
    for k in range(3):
        cells.sweep(k)
        plan.states.append(state())
    return cells, plan, uses


def test_probabilities_add_up(small):
    """Over the known words and the unknown one, the predictive probabilities of a restaurant make 1."""
    cells, plan, uses = small
    state = plan.states[-1]
    above = cells.parent(state)
    unknown = (hpylm.ROOT_STRENGTH + plan.root_discount * state.root_tables) / (plan.words + 1) / (hpylm.ROOT_STRENGTH + state.customers)
    assert abs(above.sum() + unknown - 1) < 1e-9
    known, p = cells.word, cells.probabilities(state)
    for room in range(12):
        new = (hpylm.STRENGTH + plan.discount * state.tables[room]) / (hpylm.STRENGTH + plan.seated[room])
        here = cells.rooms == room
        total = p[here].sum() + new * (above.sum() - above[known[here]].sum() + unknown)
        assert abs(total - 1) < 1e-9


def test_tables_stay_within_their_customers(small):
    cells, _, _ = small
    assert ((cells.tables >= 1) & (cells.tables <= cells.customers)).all()
    assert ((cells.root_tables >= 1) & (cells.root_tables <= cells.root_customers)).all()


def test_number_of_tables_is_that_of_the_process():
    """Without discount the expected number of tables is the sum of a / (a + k)."""
    rng = np.random.default_rng(4)
    for n in (5, 40, 1_000):
        got = hpylm.sit_down(np.full(4_000, n), lambda k, t: np.full(len(k), 2.0), 0.0, None, rng).mean()
        want = 1 + sum(2.0 / (2.0 + k) for k in range(1, n))
        assert abs(got / want - 1) < 0.03


def test_each_context_has_its_own_restaurant():
    """With more than 2 ** 16 words before, the customers a part gets back are those of one word before, over all parts."""
    text = " ".join(f"w{k} {'xyz'[k % 3]}" for k in range(100_000))
    frame = pd.DataFrame({"doc_id": [0, 1], "text": [text, "w7 x w7 z"], "held_out": [False, False], "row": [0, 1]})
    hot = np.zeros(0, np.uint64)
    dealt = pd.concat(hpylm._deal(hot, 3)([frame]))
    parts = [hpylm._gather(hot, 2)(rows) for _, rows in dealt[dealt["kind"] == "tokens"].groupby("part")]
    sent = pd.concat(parts).query("kind == 'sent'")
    index = pd.concat([hpylm._index(rows) for _, rows in sent.groupby("bucket")])
    met = pd.concat([index[index["kind"] == "seated"], *[hpylm._meet(rows) for _, rows in pd.concat([sent, index[index["kind"] == "index"]]).groupby("bucket")]])
    empty = hpylm.Plan(hot, np.zeros(0), np.zeros(1), 0, 0, 0, 0)
    plan = hpylm.make_plan(sum(hpylm.Cells(t, empty, 0, c).counts() for p in parts for t, c in p.loc[p["kind"] == "cells", ["types", "contexts"]].to_numpy()), hot)
    before = Counter(b for t in frame["text"] for b in [None, *tokens(t)[:-1]])
    rooms, pairs = [], 0
    for part in parts:
        cells, _, _ = hpylm._part(pd.concat([part[part["kind"] != "sent"], met[met["part"] == part["part"].iloc[0]]]), plan)
        names = np.concatenate([hpylm._expand(d, np.uint64, np.uint32)[0] for d in part.query("kind == 'sent'").sort_values("bucket")["contexts"]])
        rooms.append(pd.DataFrame({"context": names, "seated": cells.plan.seated, "tables": cells.plan.states[0].tables}))
        pairs += len(cells.rooms)
    rooms = pd.concat(rooms).drop_duplicates()
    kinds = Counter(b for b, _ in {(b, w) for t in frame["text"] for b, w in zip([None, *tokens(t)], tokens(t))})
    assert len(rooms) == len(before) > hpylm.RESTAURANTS and sorted(rooms["seated"]) == sorted(before.values())
    assert sorted(rooms["tables"]) == sorted(kinds.values()) and pairs == sum(kinds.values())
    assert plan.tokens == sum(before.values())


def test_hashes_are_packed_by_their_steps():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 64, 50_000, dtype=np.uint64)
    ascending, uses = np.sort(hashes), rng.integers(0, 9, 7).astype(np.uint32)
    packed = hpylm._squeeze(ascending, uses)
    assert len(packed) < 6.7 * len(hashes)
    for some in (ascending, hashes, hashes[:1], hashes[:0], np.array([(1 << 64) - 1, 0, 2], np.uint64)):
        first, second = hpylm._expand(hpylm._squeeze(some, uses), np.uint64, np.uint32)
        assert (first == some).all() and len(first) == len(some) and (second == uses).all()


def test_dealt_words_before_are_sent_in_ascending_order():
    """A row's contexts are told by the words before, which are in order; the start of a text comes last."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5_000, 200)) for _ in range(100)]
    frame = pd.DataFrame({"doc_id": range(100), "text": texts, "held_out": False, "row": range(100)})
    rows = pd.concat(hpylm._deal(np.zeros(0, np.uint64), 2)(iter([frame])))
    words = np.unique(np.concatenate([hpylm.token_stream([t.encode() for t in texts])[0], [hpylm.START]]))
    seen = []
    for data in rows.loc[rows["kind"] == "tokens", "contexts"]:
        before, = hpylm._expand(data, np.uint64)
        body = before[:-1] if before[-1] == hpylm.START else before
        assert (np.diff(body.astype(float)) > 0).all() and len(data) < 7 * len(before) + 50
        seen.append(before)
    assert set(np.concatenate(seen).tolist()) == set(words.tolist()) - {int(hpylm.END)}
