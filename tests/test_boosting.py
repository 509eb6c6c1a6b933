"""Boosted trees against a plain implementation, and contributions against all subsets."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annualis.operators import boosting as B
from annualis.operators import tree_attribution as T

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows():
    """Few and many distinct values, a target of interactions, and rows that teach nothing."""
    rng = np.random.default_rng(11)
    x = pd.DataFrame({"id": range(700), "a": rng.integers(0, 5, 700) * 1.0, "b": rng.normal(size=700).round(2), "c": rng.integers(0, 2, 700) * 1.0, "d": rng.normal(size=700)})
    x["y"] = (x["a"] * x["c"] + np.abs(x["b"]) * 2 + (x["d"] > 0.3) * x["a"]).round(3)
    x.loc[3, "y"] = np.nan
    x["fold"] = x["id"] % 3 + 1
    return x


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    df = spark.createDataFrame(rows).withColumn("y", F.when(F.col("id") != 4, F.col("y"))).withColumn("b", F.when(F.col("id") % 50 != 7, F.col("b")))
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def plain_tree(x, g, p, cuts, columns):
    """Node number to (column, cut, gain, rows, weight), by trying every cut on the rows themselves."""
    strength = lambda s: math.copysign(max(abs(s) - p.l1, 0), s)
    score = lambda s, n: strength(s) ** 2 / (n + p.l2)
    out, waiting = {}, [(0, np.arange(len(x)), 0)]
    while waiting:
        node, own, level = waiting.pop()
        s = g[own].sum()
        best = (B.LEAST_GAIN, None, None)
        for c in columns if level < p.depth else []:
            for t in cuts[c]:
                left = x[own, c] <= t
                n = int(left.sum())
                if min(n, len(own) - n) < max(1, p.min_rows):
                    continue
                a = g[own][left].sum()
                gain = score(a, n) + score(s - a, len(own) - n) - score(s, len(own))
                if gain > best[0] + 1e-9:
                    best = (gain, c, t)
        out[node] = (best[1], best[2], best[0] if best[1] is not None else 0.0, len(own), -strength(s) / (len(own) + p.l2) * p.step)
        if best[1] is not None:
            left = x[own, best[1]] <= best[2]
            waiting += [(2 * node + 1, own[left], level + 1), (2 * node + 2, own[~left], level + 1)]
    return out


def plain_fit(frame, keys, p, cuts):
    """All trees, one row and one cut at a time; the draws of rows and columns are the operator's."""
    x, y = frame[NAMES].fillna(0.0).to_numpy(), frame["y"].to_numpy()
    base = round(float(y.mean()), 6)
    predicted, trees = np.full(len(y), base), []
    for number in range(p.trees):
        drawn = np.flatnonzero(p.sampled(keys, number))
        tree = plain_tree(x[drawn], (predicted - y)[drawn], p, cuts, p.drawn(number, len(NAMES)))
        trees.append(tree)
        for k, row in enumerate(x):
            node = 0
            while tree[node][0] is not None:
                node = 2 * node + 1 + int(not row[tree[node][0]] <= tree[node][1])
            predicted[k] += tree[node][4]
    return base, trees, predicted


@pytest.mark.parametrize("one_task", [0, None])
def test_same_trees_as_a_plain_implementation(table, one_task):
    params = {"trees": 12, "depth": 3, "step": 0.3, "bins": 64}
    p = B.Params.of(params)
    model = B.fit_together(table, NAMES, "y", ["id"], {"all": F.lit(True)}, params, one_task)["all"]
    seen = table.filter("y is not null and not isnan(y)").withColumn("key", B.text_hash(p.seed, F.col("id"))).toPandas()
    filled = table.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in NAMES], "y").filter("y is not null and not isnan(y)")
    cuts = B.cut_points(filled, NAMES, p.bins)
    base, trees, predicted = plain_fit(seen, seen["key"].to_numpy(), p, cuts)
    assert model.base == base and len(cuts[0]) == 4 and len(cuts[2]) == 1 and len(cuts[3]) > 40
    for number, tree in enumerate(trees):
        own = model.trees[model.trees["tree"] == number].set_index("node")
        assert set(own.index) == set(tree)
        for node, (c, t, gain, n, weight) in tree.items():
            r = own.loc[node]
            assert (r["feature"], r["n_rows"]) == (None if c is None else NAMES[c], n)
            assert c is None or r["cut"] == t
            assert r["gain"] == pytest.approx(gain, rel=1e-6, abs=1e-9) and r["weight"] == pytest.approx(weight, abs=1e-9)
    out = {r["id"]: r["prediction"] for r in model.transform(table).collect()}
    assert [out[i] for i in seen["id"]] == pytest.approx(predicted, abs=1e-9)


def test_blocks_and_tasks_grow_the_same_bits(table, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 90)
    monkeypatch.setattr(B, "STORE_EVERY", 2)
    parts = {"all": F.lit(True), "no": F.lit(False), **{f"f{k}": F.col("fold") != k for k in (1, 2, 3)}}
    params = {"trees": 5, "depth": 4}
    a = B.fit_together(table, NAMES, "y", ["id"], parts, params, one_task=0)
    b = B.fit_together(table.repartition(7), NAMES, "y", ["id"], parts, params)
    for name in parts:
        assert a[name].trees.equals(b[name].trees) and a[name].base == b[name].base
    assert len(a["no"].trees) == 0 and a["no"].predict(np.ones((2, 4))).tolist() == [0.0, 0.0]
    alone = B.fit(table.filter("fold <> 2"), NAMES, "y", ["id"], params, "f2")
    same = a["f2"].trees.drop(columns=["cut"])  # its cuts come from all rows
    assert len(alone.trees) > 20 and len(same) > 20


def test_learns_and_is_saved(spark, table, tmp_path):
    model = B.fit(table, NAMES, "y", ["id"], {"trees": 150, "step": 0.1})
    out = model.transform(table.filter("y is not null and not isnan(y)"))
    assert out.agg(F.corr("y", "prediction")).first()[0] > 0.98
    model.save(spark, str(tmp_path / "model"))
    again = B.Booster.load(spark, str(tmp_path / "model"))
    x = np.random.default_rng(0).normal(size=(50, 4))
    x[0, 0] = np.nan
    assert again.features == NAMES and again.predict(x).tolist() == model.predict(x).tolist()
    gains = model.gains().set_index("feature")["importance"]
    assert gains.sum() == pytest.approx(1.0) and gains["a"] > gains["d"]


def test_penalties_and_least_rows(table):
    bare = B.fit(table, NAMES, "y", ["id"], {"trees": 1, "depth": 2, "l1": 0.0, "l2": 0.0, "row_sample": 1.0, "step": 1.0})
    held = B.fit(table, NAMES, "y", ["id"], {"trees": 1, "depth": 2, "l1": 1e9, "row_sample": 1.0})
    assert held.trees["weight"].tolist() == [0.0]
    assert bare.trees["n_rows"].iloc[0] == 698 and bare.trees["weight"].abs().max() > 0.5
    few = B.fit(table, NAMES, "y", ["id"], {"trees": 2, "min_rows": 200, "row_sample": 1.0})
    assert few.trees["n_rows"].min() >= 200


def test_no_rows(table):
    model = B.fit(table.filter("false"), NAMES, "y", ["id"], {"trees": 2})
    assert model.transform(table).agg(F.max(F.abs("prediction"))).first()[0] == 0.0
    assert T.expected_value(model) == 0.0 and model.gains()["importance"].tolist() == [0.0] * 4


def value_of(tree, known, x):
    """Mean of a tree over its training rows when only some inputs are known."""
    def down(node):
        r = tree.loc[node]
        if r["feature"] is None:
            return r["weight"]
        if r["feature"] in known:
            return down(2 * node + 1 if x[NAMES.index(r["feature"])] <= r["cut"] else 2 * node + 2)
        a, b = tree.loc[2 * node + 1, "n_rows"], tree.loc[2 * node + 2, "n_rows"]
        return (a * down(2 * node + 1) + b * down(2 * node + 2)) / (a + b)

    return down(0)


def test_contributions_are_shapley_values(table):
    model = B.fit(table, NAMES, "y", ["id"], {"trees": 3, "depth": 5, "step": 0.5, "column_sample": 1.0})
    x = np.random.default_rng(1).normal(size=(6, 4)) * 2
    found = T.Explainer(model).contributions(x)
    trees = [t.set_index("node") for _, t in model.trees.groupby("tree")]
    for k, row in enumerate(x):
        for i, name in enumerate(NAMES):
            total, others = 0.0, [n for n in NAMES if n != name]
            for size in range(4):
                for known in itertools.combinations(others, size):
                    share = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                    total += share * sum(value_of(t, {*known, name}, row) - value_of(t, set(known), row) for t in trees)
            assert found[k, i] == pytest.approx(total, abs=1e-9)
    assert found.sum(axis=1) + T.expected_value(model) == pytest.approx(model.predict(x), abs=1e-9)


def test_contributions_of_rows(table):
    model = B.fit(table, NAMES, "y", ["id"], {"trees": 20})
    long = T.tree_attributions(model.transform(table), ["id", "prediction"], model)
    sums = long.groupBy("id").agg(F.sum("contribution").alias("s"), F.first("prediction").alias("p")).collect()
    assert len(sums) == 700 and all(r["s"] + T.expected_value(model) == pytest.approx(r["p"], abs=1e-9) for r in sums)
    assert T.mean_abs_contributions(table, model, ["fold"]).count() == 12


def test_held_rows_and_passes_grow_the_same_bits(table, monkeypatch):
    monkeypatch.setattr(B, "FEW", 20)
    monkeypatch.setattr(B, "JOINT", 300)
    parts = {"all": F.lit(True), "no": F.lit(False), **{f"f{k}": F.col("fold") != k for k in (1, 2, 3)}}
    params = {"trees": 4, "depth": 5, "bins": 32}
    held = B.fit_together(table, NAMES, "y", ["id"], parts, params, one_task=0)
    monkeypatch.setattr(B, "_held_tasks", lambda *_: 0)
    passes = B.fit_together(table, NAMES, "y", ["id"], parts, params, one_task=0)
    alone = B.fit_together(table, NAMES, "y", ["id"], parts, params)
    for name in parts:
        assert held[name].trees.equals(alone[name].trees) and passes[name].trees.equals(alone[name].trees)
    assert len(alone["all"].trees) > 40


def test_held_rows_take_no_job_for_each_level(spark, table):
    spark.sparkContext.setJobGroup("held", "held")
    try:
        B.fit_together(table, NAMES, "y", ["id"], {"all": F.lit(True)}, {"trees": 20, "depth": 4}, one_task=0)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("held")) < 20


def test_columns_counted_together_or_alone():
    """Sums of nodes by combined bins, by one column and by several nodes at once."""
    rng = np.random.default_rng(5)
    n, sizes = 30_000, [3, 5, 40, 256]
    bins = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    p = B.Params.of({"row_sample": 1.0, "column_sample": 1.0, "depth": 4})
    block = B.Block(bins, rng.integers(-999, 999, n) * 1.0, np.arange(n), np.ones(n, np.int64), np.zeros((1, n)))
    tree, columns = B.Tree(p, 1.0), np.arange(4)
    place = np.zeros(n, np.int64)
    for level in range(4):
        g, s = block.sums(0, 0, tree, level, columns)
        for k, node in enumerate(tree.counted):
            for c in columns:
                own = place == node
                assert (g[k, c] == np.bincount(bins[c, own], -block.y[own], 256)).all() and (s[k, c] == np.bincount(bins[c, own], minlength=256)).all()
        tree.grow(g, s, columns, level == 3)
        split = tree.column[place]
        place = np.where(split < 0, place, 2 * place + 1 + (bins[split, np.arange(n)] > tree.bin[place]))
    assert block.joint(0, columns)[0][0] is not None
    block.add(0, tree, 0)
    assert (block.predicted[0] == tree.weight[place]).all()


@pytest.mark.parametrize("depth", [3, 6, 7])
def test_predictions_follow_the_cuts(table, depth):
    """Trees of up to and beyond 64 leaves; values on a cut, beyond all, and not numbers."""
    model = B.fit(table, NAMES, "y", ["id"], {"trees": 6, "depth": depth, "min_rows": 1})
    x = np.random.default_rng(2).normal(size=(200, 4)) * 2
    x[:4], x[4:8], x[8:12] = np.nan, np.inf, -np.inf
    cuts = model.trees["cut"].dropna().to_numpy()
    x[12:100] = np.random.default_rng(3).choice(cuts, (88, 4))
    expected = []
    for row in x:
        out = model.base
        for _, tree in model.trees.groupby("tree"):
            nodes, node = tree.set_index("node"), 0
            while nodes.loc[node, "feature"] is not None:
                node = 2 * node + 1 + int(not row[NAMES.index(nodes.loc[node, "feature"])] <= nodes.loc[node, "cut"])
            out += nodes.loc[node, "weight"]
        expected.append(out)
    assert model.predict(x).tolist() == expected
    found = T.Explainer(model).contributions(x)
    assert found.sum(axis=1) + T.expected_value(model) == pytest.approx(expected, abs=1e-9)


def test_branches_share_tables(table, monkeypatch):
    """A row looks up fewer tables than a tree has leaves, and the size of the tables changes no value."""
    model = B.fit(table, NAMES, "y", ["id"], {"trees": 5, "depth": 6})
    x = np.random.default_rng(4).normal(size=(100, 4)) * 2
    large = T.Explainer(model)
    leaves = model.trees["feature"].isna().sum()
    assert 4 * sum(len(tables) for _, tables in large.trees) < leaves
    monkeypatch.setattr(T, "CELLS", 8)
    small = T.Explainer(model)
    assert small.contributions(x) == pytest.approx(large.contributions(x), abs=1e-12)
    assert sum(len(tables) for _, tables in small.trees) > sum(len(tables) for _, tables in large.trees)
