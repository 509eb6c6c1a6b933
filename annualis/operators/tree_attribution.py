"""Contributions of the inputs to the predictions of boosted trees: exact Shapley values along the paths.

On a path to a leaf, an input's conditions are one interval; a row meets it or not, and an unknown input would meet it with the share of
the training rows that do. With D inputs on the path a leaf has 2 ** D cases, whose Shapley weights are tabulated once for a task. Leaves of a
branch with few cuts share a table by the intervals that these cuts make, so a row looks up one sum for each branch. Contributions add up to
the prediction less the mean over the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from copy import copy
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.operators.boosting import Booster

CHUNK = 4096  # rows that are looked up at a time
CELLS = 512  # combined intervals of a branch's cuts, at most


class Paths:
    """Leaves of one tree that have equally many inputs on their path."""

    def __init__(self, weight: np.ndarray, inputs: np.ndarray, low: np.ndarray, high: np.ndarray, share: np.ndarray, features: int):
        leaves, depth = inputs.shape
        self.inputs, self.low, self.high, self.features = inputs, low, high, features
        bits = np.arange(1 << depth)[:, None] >> np.arange(depth) & 1  # (case, input)
        table = np.empty((leaves, 1 << depth, depth))
        orders = np.array([factorial(s) * factorial(depth - 1 - s) / factorial(depth) for s in range(depth)])
        for i in range(depth):
            # coefficients of the product over the other inputs of share + met * t: that of t ** s sums over sets of s known inputs
            known = np.zeros((leaves, 1 << depth, depth))
            known[:, :, 0] = 1
            for j in range(depth):
                if j != i:
                    more = np.zeros_like(known)
                    more[:, :, 1:] = known[:, :, :-1] * bits[:, j, None]
                    known = known * share[:, j, None, None] + more
            table[:, :, i] = (bits[:, i] - share[:, i, None]) * (known @ orders)
        self.table = table * weight[:, None, None]
        self._lay()

    def _lay(self) -> None:
        leaves, depth = self.inputs.shape
        self.places = np.arange(leaves) << depth
        self.cases = 1 << np.arange(depth)
        self.to = np.zeros((leaves * depth, self.features))
        self.to[np.arange(leaves * depth), self.inputs.ravel()] = 1
        self.flat = self.table.reshape(leaves << depth, depth)

    def some(self, at: Sequence[int]) -> Paths:
        out = copy(self)
        out.inputs, out.low, out.high, out.table = self.inputs[at], self.low[at], self.high[at], self.table[at]
        out._lay()
        return out

    def of(self, x: np.ndarray) -> np.ndarray:
        own = x[:, self.inputs]
        case = ((own > self.low) & (own <= self.high)) @ self.cases
        return self.flat[case + self.places].reshape(len(x), -1) @ self.to


def _leaves(column: np.ndarray, cut: np.ndarray, weight: np.ndarray, rows: np.ndarray, node: int = 0, path: dict | None = None) -> list[tuple[int, float, dict]]:
    """Leaves below a node from the left: number, weight, and by input the interval on the path and the share of rows that meet it."""
    path = path or {}
    if column[node] < 0:
        return [(node, weight[node], path)]
    f, t = int(column[node]), cut[node]
    low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
    out = []
    for child, edges in ((2 * node + 1, (low, min(high, t))), (2 * node + 2, (max(low, t), high))):
        out += _leaves(column, cut, weight, rows, child, {**path, f: (*edges, share * rows[child] / rows[node])})
    return out


def tree_paths(leaves: Sequence[tuple[int, float, dict]], features: int) -> dict[int, tuple[Paths, dict[int, int]]]:
    """The leaves by the number of inputs on their paths, each number with the leaves' places by node."""
    out = {}
    for depth in {len(path) for _, _, path in leaves}:
        own = [leaf for leaf in leaves if len(leaf[2]) == depth]
        inputs = np.array([list(path) for _, _, path in own])
        low, high, share = (np.array([[v[k] for v in path.values()] for _, _, path in own], float) for k in range(3))
        out[depth] = Paths(np.array([w for _, w, _ in own]), inputs, low, high, share, features), {node: k for k, (node, _, _) in enumerate(own)}
    return out


def tree_mean(column: np.ndarray, cut: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> float:
    """The mean of a tree over its training rows."""
    return float(sum(w * np.prod([s for _, _, s in path.values()]) for _, w, path in _leaves(column, cut, weight, rows)))


class Branch:
    """The contributions of some leaves of a tree, by the intervals between the cuts on their paths."""

    def __init__(self, leaves: Sequence[tuple[int, float, dict]], features: int):
        bounds: dict[int, set] = {}
        for _, _, path in leaves:
            for f, (low, high, _) in path.items():
                bounds.setdefault(f, set()).update(b for b in (low, high) if np.isfinite(b))
        self.cuts = {f: np.array(sorted(own)) for f, own in sorted(bounds.items())}
        self.leaves, self.features = leaves, features
        self.cells = int(np.prod([len(c) + 1 for c in self.cuts.values()], dtype=object)) if self.cuts else 1

    def parted(self) -> list[Branch]:
        """This, or as many smaller branches as it takes for each to have ``CELLS`` cells at most."""
        if self.cells <= CELLS or len(self.leaves) == 1:
            return [self]
        depth = lambda node: (node + 1).bit_length() - 1
        above = lambda node, d: ((node + 1) >> (depth(node) - d)) - 1
        nodes = [leaf[0] for leaf in self.leaves]
        d = next(d for d in range(1, 64) if len({above(k, d) for k in nodes}) > 1)
        first = above(nodes[0], d)
        halves = [leaf for leaf in self.leaves if above(leaf[0], d) == first], [leaf for leaf in self.leaves if above(leaf[0], d) != first]
        return [small for own in halves for small in Branch(own, self.features).parted()]

    def table(self, paths: dict[int, tuple[Paths, dict[int, int]]]) -> np.ndarray:
        """Contributions by cell, the last input's interval running fastest."""
        x = np.zeros((self.cells, self.features))
        each = np.meshgrid(*[np.concatenate([c[:1], np.nextafter(c, np.inf)]) for c in self.cuts.values()], indexing="ij")
        for f, values in zip(self.cuts, each):
            x[:, f] = values.ravel()
        out = np.zeros((self.cells, self.features))
        for depth, (every, places) in paths.items():
            if own := [places[node] for node, _, path in self.leaves if len(path) == depth]:
                out += every.some(own).of(x)
        return out


class Explainer:
    """All trees of a model by their branches."""

    def __init__(self, model: Booster):
        self.n, self.cuts = len(model.features), model.cuts()
        self.model, self.mean, self.trees = model, expected_value(model), []
        for tree in zip(*model.arrays()):
            leaves = _leaves(*tree)
            branches = [] if len(leaves) == 1 else Branch(leaves, self.n).parted()
            paths = tree_paths(leaves, self.n) if branches else {}
            kind = np.uint16 if all(b.cells <= 1 << 16 for b in branches) else np.int64
            steps: dict[int, np.ndarray] = {}  # by feature and code, the way to the cell of each branch
            for k, branch in enumerate(branches):
                stride = branch.cells
                for f, cuts in branch.cuts.items():
                    stride //= len(cuts) + 1
                    own = steps.setdefault(f, np.zeros((len(self.cuts[f]) + 1, len(branches)), kind))
                    own[:, k] = np.searchsorted(np.searchsorted(self.cuts[f], cuts), np.arange(len(own))) * stride
            self.trees.append((list(steps.items()), [b.table(paths) for b in branches]))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Of each input (column) to each row's prediction; a NaN goes right at every cut, as in ``Booster.predict``."""
        out = np.zeros(x.shape)
        for a in range(0, len(x), CHUNK):
            codes, own = self.model.coded(x[a:a + CHUNK]), out[a:a + CHUNK]
            for steps, tables in self.trees:
                cell = None
                for f, by_code in steps:
                    more = by_code.take(codes[f], axis=0, mode="clip")
                    cell = more if cell is None else np.add(cell, more, out=cell)
                for k, table in enumerate(tables):
                    own += table.take(cell[:, k], axis=0, mode="clip")
        return out


def expected_value(model: Booster) -> float:
    """The model's mean prediction over its training rows, as its trees have counted them."""
    return model.base + sum(tree_mean(*tree) for tree in zip(*model.arrays()))


def with_contributions(df: DataFrame, model: Booster, name: str = "contributions") -> DataFrame:
    """``df`` with an array of contributions, in the order of the model's features; NULL and NaN inputs count as 0."""
    explainer = Explainer(Booster(model.name, model.features, model.base, model.trees))  # some dozen MB for 300 trees; Spark sends it to each executor once

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for inputs in batches:
            yield pd.Series(list(explainer.contributions(inputs.to_numpy(np.float64))), dtype=object)

    filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in model.features]
    return df.withColumn(name, run(F.struct(*filled)))


def tree_attributions(df: DataFrame, keys: Sequence[str], model: Booster) -> DataFrame:
    """Long table ``(keys, feature, value, contribution)``."""
    wide = with_contributions(df, model, "_c")
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.get("_c", F.lit(k)).alias("contribution"))
                     for k, f in enumerate(model.features)])
    return wide.select(*keys, F.inline(each))


def mean_abs_contributions(df: DataFrame, model: Booster, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute contribution of each feature, overall or by class, from one wide row a class."""
    wide = with_contributions(df, model, "_c")
    means = wide.groupBy(*by).agg(*[F.avg(F.abs(F.get("_c", F.lit(k)))).alias(f) for k, f in enumerate(model.features)])
    return means.unpivot(list(by), list(model.features), "feature", "mean_abs")
