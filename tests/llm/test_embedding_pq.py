import math

import numpy as np
import pytest

from annualis.llm import embedding_pq
from annualis.llm.common import merge_labels


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.05
    chain = [base[0] + k * 0.25 * np.linalg.norm(base[0]) * base[1] / np.linalg.norm(base[1]) for k in range(6)]
    rows = [*base, *near, *chain, *([base[5]] * 40), base[7] * 1e-30, base[7] * 1e30, base[9], base[9]]
    out = [(k * 2 + 1, [float(x) for x in v]) for k, v in enumerate(rows)]
    bad = [None, [], [0.0] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    out += [(10_000 + k, v) for k, v in enumerate(bad)]
    return out + [(1, out[0][1]), (None, out[3][1]), (None, None)]


def expected(rows):
    sound = [k for k, (_, v) in enumerate(rows) if v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([rows[k][1] for k in sound])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(x @ x.T >= 0.95)
    label = merge_labels(np.arange(len(x)), i, j)
    n = np.bincount(i, minlength=len(x)) - 1
    out = [(v, 0, v, v is not None) for k, (v, _) in enumerate(rows) if k not in set(sound)]
    for k, at in enumerate(sound):
        ids = [rows[sound[m]][0] for m in np.flatnonzero(label == label[k]) if rows[sound[m]][0] is not None]
        component = min(ids, default=None)
        own = rows[at][0]
        out.append((own, int(n[k]), component, own is not None and own == component))
    return sorted(out, key=str)


def collected(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def test_all_links(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], "vec_id long, embedding array<double>, cls string, first string")
    assert collected(embedding_pq.embedding_links(df)) == expected(vectors)


def test_blocks_and_turns(spark, vectors, monkeypatch):
    monkeypatch.setattr(embedding_pq, "MEMBERS", 7)
    monkeypatch.setattr(embedding_pq, "ASKING", 11)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    assert collected(embedding_pq.embedding_links(df)) == expected(vectors)


def test_no_usable_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert collected(embedding_pq.embedding_links(df)) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_pq.embedding_links(df.filter("false")).count() == 0


def test_recall_at_the_threshold():
    """Pairs right at the cosine, turned at random: the lists asked hold nearly all partners."""
    rng = np.random.default_rng(0)
    base = embedding_pq.unit(rng.normal(size=(20_000, 64)))
    x = base[:4_000]
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * embedding_pq.unit(turn)
    q = embedding_pq.Quantiser(base[:8_192], 256)
    home_x, probes_x = q.home_and_probes(x)
    home_y, probes_y = q.home_and_probes(y)
    rows = np.arange(len(x))
    assert (probes_x[rows, home_y] | probes_y[rows, home_x]).mean() > 0.97


def test_lookups_bound_distances():
    rng = np.random.default_rng(1)
    rows = embedding_pq.unit(rng.normal(size=(2_000, 20)))
    q = embedding_pq.Quantiser(rows, 8)
    home, _ = q.home_and_probes(rows)
    codes, lost = q.encode(rows, home)
    own = np.flatnonzero(home == 3)
    estimate = np.sqrt(q.estimates(rows[:50], 3, codes[own]))
    true = np.sqrt(embedding_pq._squares(rows[:50], rows[own]))
    assert (true >= estimate - lost[own] - 1e-3).all() and (true <= estimate + lost[own] + 1e-3).all()
