import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annualis.llm import cover_tree, pivot_search, vectors
from annualis.llm.cover_tree import CoverTree, embedding_negatives, hard_negatives
from annualis.llm.pivot_search import embedding_neighbours, top_k

BAD = [None, [math.nan, 1.0, 1.0], [math.inf, 1.0, 1.0], [None, 1.0, 1.0], [-math.inf]]


def rows_of(kind, n=900, width=6):
    """(vec_id, vector, label) with clusters, a third of equal rows, ties, bad vectors, null labels, repeated and null ids."""
    rng = np.random.default_rng(kind)
    centers = rng.normal(size=(12, width)) * 3
    x = centers[rng.integers(0, 12, n)] + rng.normal(size=(n, width)) * 0.3 if kind % 2 else rng.normal(size=(n, width))
    x[rng.random(n) < 0.33] = x[0]
    x[5:9] = 0.0
    ids = rng.permutation(n * 2)[:n].tolist()
    rows = [(i, [float(v) for v in r], int(k)) for i, r, k in zip(ids, x, rng.integers(0, 10, n))]
    rows += [(i, v, 3) for i, v in zip((50, 100, 150, 200, None), BAD)]
    rows += [(250, rows[1][1], None), (ids[2], rows[2][1], rows[2][2]), (ids[3], rows[4][1], 4), (None, rows[10][1], 1), (None, rows[11][1], 2), (300, [1.5], 4), (350, [], 4)]
    return rows


def integers(v, width):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v] + [0] * (width - len(v))


def usable(rows, width, labelled):
    out = []
    for i, v, label in rows:
        w = integers(v, width)
        if w is not None and (label is not None or not labelled):
            out.append((i, w, label))
    return out


def ranking(rows, at, score):
    return sorted((k for k in range(len(rows)) if k != at), key=lambda k: (-score[k], rows[k][0] is None, rows[k][0] or 0))


def by_hand_top(rows, width, k):
    rows = usable(rows, width, False)
    x = np.array([r[1] for r in rows], np.int64)
    out = []
    for q, (i, v, _) in enumerate(rows):
        if i is not None and i % 50 == 0:
            score = x @ x[q]
            out += [(i, n + 1, rows[c][0], int(score[c])) for n, c in enumerate(ranking(rows, q, score)[:k])]
    return sorted(out, key=str)


def by_hand_negatives(rows, width):
    rows = [(i, v, k if i is None or i % 7 else (k + 1) % 10) for i, v, k in usable(rows, width, True)]
    x = np.array([r[1] for r in rows], np.int64)
    out = []
    for q, (i, _, label) in enumerate(rows):
        if i is None or i % 50:
            continue
        score = x @ x[q]
        order = ranking(rows, q, score)
        for p in [c for c in order if rows[c][2] == label][:5]:
            ps = int(score[p])
            fits = [c for c in order if rows[c][2] != label and 50 * ps <= 100 * int(score[c]) <= 95 * ps][:3]
            out += [(i, rows[p][0], n + 1, rows[c][0], ps, int(score[c])) for n, c in enumerate(fits)]
    return sorted(out, key=str)


def frame_of(spark, rows):
    kinds = "vec_id long, embedding array<double>, label int, row string, key string, score string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], kinds).repartition(3)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=["whole", "cut"])
def sizes(request, monkeypatch):
    if request.param == "cut":
        for module, name, value in ((pivot_search, "MEMBERS", 60), (pivot_search, "ASKING", 4), (pivot_search, "LIST_MEMBERS", 50), (pivot_search, "BATCH", 16),
                                    (pivot_search, "FIRST", 2), (cover_tree, "MEMBERS", 90), (cover_tree, "ASKING", 5), (cover_tree, "CELL_MEMBERS", 60),
                                    (cover_tree, "BATCH", 16), (cover_tree, "LEAF", 4), (vectors, "SAMPLE_ROWS", 70)):
            monkeypatch.setattr(module, name, value)


@pytest.mark.parametrize("kind", [0, 1])
def test_top_k(spark, sizes, kind):
    rows = rows_of(kind)
    found = embedding_neighbours(frame_of(spark, rows), 5, 50)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and collected(found) == by_hand_top(rows, 6, 5)


@pytest.mark.parametrize("kind", [2, 3])
def test_hard_negatives(spark, sizes, kind):
    rows = rows_of(kind)
    found = embedding_negatives(frame_of(spark, rows))
    wanted = by_hand_negatives(rows, 6)
    assert len(wanted) > 50 and collected(found) == wanted


def test_few_rows(spark):
    few = frame_of(spark, [(0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (3, [0.9, 1.9], 2)])
    assert collected(embedding_neighbours(few, 5, 50)) == by_hand_top([(0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (3, [0.9, 1.9], 2)], 2, 5)
    assert collected(embedding_negatives(few)) == by_hand_negatives([(0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (3, [0.9, 1.9], 2)], 2)
    for rows in ([], [(0, None, 1)], [(0, [1.0], None)]):
        df = frame_of(spark, rows)
        assert embedding_negatives(df).count() == 0
        assert embedding_neighbours(df, 5, 50).count() == 0


def test_scores_beyond_doubles(spark):
    """Products of more than 53 bits are exact."""
    rng = np.random.default_rng(8)
    x = rng.integers(-(1 << 28), 1 << 28, (120, 5))
    df = spark.createDataFrame([(int(k), [int(v) for v in r]) for k, r in enumerate(x)], "vec_id long, vector array<long>")
    found = collected(top_k(df, F.col("vec_id") < 9, 4))
    wanted = []
    for q in range(9):
        score = [sum(int(a) * int(b) for a, b in zip(x[q], r)) for r in x]
        order = sorted((k for k in range(len(x)) if k != q), key=lambda k: (-score[k], k))[:4]
        wanted += [(q, n + 1, k, score[k]) for n, k in enumerate(order)]
    assert found == sorted(wanted, key=str)
    labelled = df.withColumn("label", F.col("vec_id") % 2)
    for r in hard_negatives(labelled, F.col("vec_id") < 9).collect():
        score = sum(int(a) * int(b) for a, b in zip(x[r["anchor_id"]], x[r["negative_id"]]))
        assert score == r["negative_score"] and 50 * r["positive_score"] <= 100 * score <= 95 * r["positive_score"]


def test_vectors_too_long_to_score(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (50, [1.0, 1.0]), (1, [2.0, 0.5])], "vec_id long, embedding array<double>")
    assert collected(embedding_neighbours(df, 5, 50)) == [(50, 1, 1, 163840)]


def test_tree_covers_and_bounds():
    rng = np.random.default_rng(4)
    rows = (rng.normal(size=(700, 5)) * 300 + rng.integers(0, 5, (700, 1)) * 2_000).astype(np.int64)
    longest = float(vectors.squares(rows).max())
    blank = np.zeros(700, np.int64)
    tree = CoverTree.build(rows, np.arange(700), blank.astype(bool), np.arange(700), blank, longest)
    queries = (rng.normal(size=(20, 5)) * 900).astype(np.int64)
    low, high = tree.bounds(queries)
    points = np.concatenate([tree.rows, np.sqrt(np.maximum(longest - vectors.squares(tree.rows), 0))[:, None]], axis=1)
    assert np.array_equal(np.sort(tree.ids), np.arange(700)) and len(tree.center) > 20
    for node in range(len(tree.center)):
        a, b = tree.begin[node], tree.end[node]
        assert np.linalg.norm(points[a:b] - points[tree.center[node]], axis=1).max() <= tree.radius[node] + 1e-3
        scores = queries @ tree.rows[a:b].T
        assert (scores.min(axis=1) >= low[:, node]).all() and (scores.max(axis=1) <= high[:, node]).all()
        x, y = tree.first_child[node], tree.last_child[node]
        if x < y:
            assert tree.begin[x] == a and tree.end[y - 1] == b and (tree.begin[x + 1:y] == tree.end[x:y - 1]).all()


@pytest.mark.parametrize("held", [1 << 18, 700])
def test_queries_of_a_task_are_compared_at_once(monkeypatch, held):
    """A leaf is compared with all queries that come to it in a round, and each window has its first rows, ties and nulls included."""
    monkeypatch.setattr(cover_tree, "AT_ONCE", held, raising=False)
    rng = np.random.default_rng(11)
    rows = np.round(rng.normal(size=(2_000, 24)) * 3).astype(np.int64)
    rows[1_200:] = rows[:20].repeat(40, axis=0) + rng.integers(-1, 2, (800, 24))
    rows[300:320] = rows[300]
    ids, nulls, labels = rng.integers(0, 900, 2_000), rng.random(2_000) < 0.05, rng.integers(0, 4, 2_000)
    tree = CoverTree.build(rows, ids, nulls, np.arange(2_000), labels, float(vectors.squares(rows).max()))
    at = rng.choice(2_000, 300, replace=False)
    keys, queries = np.array([f"{k:032x}" for k in range(300)], "S32"), rows[at]
    sizes = rng.integers(1, 4, 300)
    scores = queries @ rows.T
    owner = np.repeat(np.arange(300), sizes)
    most = np.sort(scores, axis=1)[owner, rng.integers(-900, 0, len(owner))]
    edges = np.stack([most - rng.integers(0, 120, len(owner)), most, np.full(len(owner), cover_tree.LOWEST)], axis=1)
    calls = []
    monkeypatch.setattr(cover_tree, "products", lambda a, b: calls.append(1) or vectors.products(a, b))
    asks = [vectors.pack(keys[a:b], queries[a:b], labels[at][a:b], sizes[a:b], edges[(owner >= a) & (owner < b)]) for a, b in ((0, 200), (200, 300))]
    for others in (True, False):
        calls.clear()
        out = cover_tree._mine(3, others)(pd.DataFrame({"own": [tree.packed(), None, None], "ask": [None, *asks]}))
        assert held == 700 or len(calls) < 600, "one call for each query and leaf"
        wanted = set()
        for q, (low, high, _) in zip(owner, edges.tolist()):
            fits = np.flatnonzero(((labels != labels[at[q]]) == others) & (scores[q] >= low) & (scores[q] <= high))
            first = fits[np.lexsort((fits, ids[fits], nulls[fits], -scores[q, fits]))[:3]]
            wanted |= {(keys[q].decode(), None if nulls[k] else int(ids[k]), int(k), int(scores[q, k]), low, high) for k in first}
        assert len(wanted) > 500 and {tuple(None if x is pd.NA else x for x in r) for r in out.astype(object).itertuples(index=False)} == wanted


def test_few_candidates_are_evaluated_when_pivots_are_near():
    rng = np.random.default_rng(6)
    rows = (rng.normal(size=(60, 8)) * 4_000)[rng.integers(0, 60, 4_000)].astype(np.int64) + rng.integers(-40, 40, (4_000, 8))
    pivots = pivot_search.Pivots(rows[:1_000], int(vectors.squares(rows).max()), 8, 6)
    own, table = rows[:20], pivots.table(rows)
    least = pivots.thresholds(own)
    bound = np.abs(table[None] - pivots.query_table(own)[:, None]).max(axis=2)
    some = pivots.reach(vectors.squares(own)[:, None].astype(float), bound) >= least[:, None]
    scores = own @ rows.T
    assert (some | (scores < least[:, None])).all() and some.mean() < 0.2
