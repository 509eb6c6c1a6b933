"""Boosted regression trees with second-order splits, L1 and L2 penalties and columns drawn for each tree.

Inputs are cut into bins. A level of a tree needs only the sums of gradients and the numbers of rows by (model, node, input,
bin). Several models grow together, each from its own part of the rows.

Tables of up to ``ONE_TASK`` rows are grown by one task a model. Larger ones are held by tasks that run at the same time: each
keeps its rows by node and they add up their sums level by level through files in the shared folder. Where rows don't fit these
tasks, or the folder is no file system that Python can write, a level is a pass over stored blocks of binned columns and one
aggregation, and every few trees the blocks are stored with their new predictions; only sums and splits come to the driver then.

Gradients are whole multiples of a unit, so their sums are exact, and a model doesn't depend on how the rows are spread or which
of the three ways is taken.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from copy import copy
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis.functions.scalar import text_hash
from annualis.schemas import BOOST_PARAMS
from annualis.session import file_system, scratch_path, shared_dir, stored, stored_with

BLOCK_ROWS = 1 << 16
ONE_TASK = 1 << 20  # rows that a task may hold, at about 40 bytes each
STORE_EVERY = 10  # trees after which predictions are stored
JOINT = 1 << 16  # combined bins of columns that are counted at once
FEW = 1 << 13  # rows of a node below which nodes are counted together
HELD_BYTES = 512 << 20  # of rows that a task may hold beside others
HELD_TASKS = 64
LEAST_GAIN = 1e-6
UNIT_BITS = 40
MOST_MODELS = 62  # a row's models are bits of a long
STIR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Params:
    """How trees grow; ``bins`` bounds the places at which an input may be cut."""

    trees: int = 300
    depth: int = 6
    step: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_rows: float = 3
    l1: float = 0.1
    l2: float = 1.0
    seed: int = 42
    bins: int = 256

    @classmethod
    def of(cls, params: Mapping[str, float] | None = None) -> Params:
        if unknown := set(params or {}) - set(cls.__dataclass_fields__):
            raise ValueError(f"no such parameter: {sorted(unknown)}")
        out = cls(**{**BOOST_PARAMS, **(params or {})})
        if not 2 <= out.bins <= 256:
            raise ValueError("between 2 and 256 bins")
        return out

    def drawn(self, tree: int, n: int) -> np.ndarray:
        """The columns of a tree, the same for every model."""
        order = np.argsort(stirred(np.arange(n, dtype=np.uint64) + (np.uint64(tree) << np.uint64(20)), self.seed), kind="stable")
        return np.sort(order[: max(1, int(self.column_sample * n))])

    def sampled(self, keys: np.ndarray, tree: int) -> np.ndarray:
        """Which rows a tree is grown from, by the hash of their key."""
        if self.row_sample >= 1:
            return np.ones(len(keys), bool)
        return (stirred(keys.astype(np.uint64) + (np.uint64(tree) << np.uint64(44)), self.seed + 1) >> np.uint64(11)) < np.uint64(int(self.row_sample * 2**53))


def stirred(x: np.ndarray, seed: int) -> np.ndarray:
    out = (x ^ np.uint64(seed * int(STIR) & (1 << 64) - 1)) * STIR
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


class Tree:
    """One tree by node number, where the children of node i are 2i + 1 (bin up to the cut) and 2i + 2."""

    def __init__(self, p: Params, unit: float):
        size = 2 ** (p.depth + 1) - 1
        self.p, self.unit = p, unit
        self.column, self.bin = np.full(size, -1), np.zeros(size, np.int64)
        self.gain, self.weight = np.zeros(size), np.zeros(size)
        self.sums, self.rows = np.zeros(size), np.zeros(size, np.int64)
        self.open, self.counted, self.above = np.zeros(1, np.int64), np.zeros(1, np.int64), None

    def _strength(self, g: np.ndarray) -> np.ndarray:
        """A sum of gradients, nearer to zero by the L1 penalty."""
        g = g * self.unit
        return g - np.clip(g, -self.p.l1, self.p.l1)

    def _score(self, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = self._strength(g)
        out *= out
        out /= n + self.p.l2
        return out

    def grow(self, g: np.ndarray, n: np.ndarray, columns: np.ndarray, last: bool) -> None:
        """Split the open nodes by the sums of the counted ones, shaped (node, column, bin); the rest are what their sibling leaves of the parent.

        The cut of the highest gain wins, on ties that of the first column and the lowest bin.
        """
        if self.above is not None:
            at = np.searchsorted(self.counted, self.open)
            own = (at < len(self.counted)) & (self.counted[np.minimum(at, len(self.counted) - 1)] == self.open)
            other = np.searchsorted(self.counted, np.where(self.open % 2, self.open + 1, self.open - 1))
            at = np.where(own, at, other)
            parent = np.searchsorted(self.above[0], (self.open - 1) // 2)
            g = np.where(own[:, None, None], g[at], self.above[1][parent] - g[at])
            n = np.where(own[:, None, None], n[at], self.above[2][parent] - n[at])
        else:
            self.sums[0], self.rows[0] = g[0, 0].sum(), n[0, 0].sum()
            self.weight[0] = self._weight(self.sums[:1], self.rows[:1])[0]
        left_g, left_n = np.cumsum(g, axis=2), np.cumsum(n, axis=2)
        all_g, all_n = left_g[:, :, -1:], left_n[:, :, -1:]
        right_g, right_n = all_g - left_g, all_n - left_n
        gain = self._score(left_g, left_n)
        gain += self._score(right_g, right_n)
        gain -= self._score(all_g, all_n)
        least = max(1, self.p.min_rows)
        gain[np.minimum(left_n, right_n) < least] = -np.inf
        flat = gain.reshape(len(gain), -1)
        best = flat.argmax(axis=1)
        k = np.arange(len(flat))
        value = flat[k, best]
        split = value > LEAST_GAIN
        node, best, k = self.open[split], best[split], k[split]
        c, b = np.divmod(best, g.shape[2])
        self.column[node], self.bin[node], self.gain[node] = columns[c], b, value[split]
        for child, gs, ns in ((2 * node + 1, left_g, left_n), (2 * node + 2, right_g, right_n)):
            self.sums[child], self.rows[child] = gs[k, c, b], ns[k, c, b]
            self.weight[child] = self._weight(self.sums[child], self.rows[child])
        if last:
            self.open = self.counted = np.zeros(0, np.int64)
            return
        self.open = np.sort(np.concatenate([2 * node + 1, 2 * node + 2]))
        self.counted = np.sort(np.where(self.rows[2 * node + 1] <= self.rows[2 * node + 2], 2 * node + 1, 2 * node + 2))
        order = np.argsort(node)
        self.above = node[order], g[k[order]], n[k[order]]

    def _weight(self, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -self._strength(g) / (n + self.p.l2) * self.p.step

    def lean(self) -> Tree:
        """The same tree without the sums that only go on to the next level."""
        out = copy(self)
        out.above = None
        return out

    def parted(self, spans: Sequence[tuple[int, np.ndarray]], bins: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """One level down from nodes with their rows; leaves stay as they are."""
        out = []
        for node, rows in spans:
            column = self.column[node]
            if column < 0 or not len(rows):
                out.append((node, rows))
                continue
            right = bins[column].take(rows, mode="clip") > self.bin[node]  # the quickest of take's modes
            out += [(2 * node + 1, rows.take(np.flatnonzero(~right), mode="clip")), (2 * node + 2, rows.take(np.flatnonzero(right), mode="clip"))]
        return out

    def leaves(self, spans: Sequence[tuple[int, np.ndarray]], bins: np.ndarray) -> list[tuple[int, np.ndarray]]:
        for _ in range(self.p.depth):
            spans = self.parted(spans, bins)
        return spans


class Block:
    """Binned rows with the targets, row keys, the models they train and their predictions by these models."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, keys: np.ndarray, models: np.ndarray, predicted: np.ndarray):
        self.bins, self.y, self.keys, self.models, self.predicted = bins, y, keys, models, predicted
        self._begun: dict[int, tuple] = {}
        self._trains: dict[int, np.ndarray] = {}
        self._drawn: tuple = (None, None)
        self._joint: tuple = (None, None)
        self._sizes = [int(b.max()) + 1 if len(b) else 1 for b in bins]

    @classmethod
    def read(cls, row, columns: int, models: int) -> Block:
        n = len(row.y) // 8
        return cls(np.frombuffer(row.bins, np.uint8).reshape(columns, n), np.frombuffer(row.y), np.frombuffer(row.keys, np.int64),
                   np.frombuffer(row.models, np.int64), np.frombuffer(row.predicted).reshape(models, n).copy())

    @classmethod
    def joined(cls, blocks: Sequence[Block]) -> Block:
        join = lambda name: np.concatenate([getattr(b, name) for b in blocks], axis=-1)
        return cls(join("bins"), join("y"), join("keys"), join("models"), join("predicted"))

    def trains(self, m: int) -> np.ndarray:
        if m not in self._trains:
            self._trains[m] = self.models >> m & 1 > 0
        return self._trains[m]

    def drawn(self, p: Params, number: int) -> np.ndarray:
        if self._drawn[0] != number:
            self._drawn = number, p.sampled(self.keys, number)
        return self._drawn[1]

    def joint(self, number: int, columns: np.ndarray) -> list[tuple[np.ndarray | None, list[int], list[int]]]:
        """The drawn columns in groups of at most ``JOINT`` combined bins: these, the places among the columns, the bins of each."""
        if self._joint[0] != number:
            groups: list[list[int]] = []
            for c in sorted(range(len(columns)), key=lambda c: (self._sizes[columns[c]], c)):
                if groups and np.prod([self._sizes[columns[k]] for k in [*groups[-1], c]]) <= JOINT:
                    groups[-1].append(c)
                else:
                    groups.append([c])
            found = []
            for own in groups:
                sizes = [self._sizes[columns[c]] for c in own]
                codes = None
                if len(own) > 1 and np.prod(sizes) <= len(self.y):
                    codes = self.bins[columns[own[0]]].astype(np.uint16)
                    for c, size in zip(own[1:], sizes[1:]):
                        codes *= np.uint16(size)
                        codes += self.bins[columns[c]]
                found.append((codes, own, sizes))
            self._joint = number, found
        return self._joint[1]

    def add(self, m: int, tree: Tree, number: int | None = None) -> None:
        """The weights of a tree to the predictions of the rows that train the model; rows that it was grown from stand at its nodes already."""
        begun, rest = self._begun.pop(m, None), self.trains(m)
        spans = []
        if begun is not None and begun[0][0] == number:
            spans, rest = tree.leaves(begun[1], self.bins), rest & ~self.drawn(tree.p, number)
        spans += tree.leaves([(0, np.flatnonzero(rest))], self.bins)
        weight = np.zeros(len(self.y))
        for node, rows in spans:
            weight[rows] = tree.weight[node]
        self.predicted[m] += weight

    def sums(self, m: int, number: int, tree: Tree, level: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and numbers of rows of the nodes that are counted, by (node, column, bin)."""
        begun = self._begun.get(m)
        if begun is None or begun[0] != (number, level - 1):
            spans = [(0, np.flatnonzero(self.trains(m) & self.drawn(tree.p, number)))]
            gradient = self.predicted[m] - self.y
            gradient *= 1 / tree.unit  # a power of two
            np.rint(gradient, out=gradient)
            for _ in range(level):
                spans = tree.parted(spans, self.bins)
        else:
            _, spans, gradient = begun
            spans = tree.parted(spans, self.bins)
        self._begun[m] = (number, level), spans, gradient
        bins = tree.p.bins
        shape = (len(tree.counted), len(columns), bins)
        g, n = np.zeros(shape), np.zeros(shape)
        slot = {int(node): k for k, node in enumerate(tree.counted)}
        few = []
        for node, rows in spans:
            if node not in slot or not len(rows):
                continue
            k = slot[node]
            if len(rows) < FEW:
                few.append((k, rows))
                continue
            own = gradient.take(rows)
            for codes, places, sizes in self.joint(number, columns):
                if codes is not None and np.prod(sizes) <= len(rows):
                    at = codes.take(rows, mode="clip").astype(np.intp)
                    cells = int(np.prod(sizes))
                    both = np.bincount(at, own, cells).reshape(sizes), np.bincount(at, minlength=cells).reshape(sizes)
                    for i, (c, size) in enumerate(zip(places, sizes)):
                        others = tuple(j for j in range(len(sizes)) if j != i)
                        g[k, c, :size], n[k, c, :size] = both[0].sum(axis=others), both[1].sum(axis=others)
                else:
                    for c in places:
                        at = self.bins[columns[c]].take(rows, mode="clip").astype(np.intp)
                        g[k, c], n[k, c] = np.bincount(at, own, bins), np.bincount(at, minlength=bins)
        if few:
            rows = np.concatenate([r for _, r in few])
            slots = np.array([k for k, _ in few])
            base = np.repeat(np.arange(len(few)) * bins, [len(r) for _, r in few])
            own, size = gradient.take(rows), len(few) * bins
            for c, column in enumerate(columns):
                at = base + self.bins[column].take(rows, mode="clip")
                g[slots, c] = np.bincount(at, own, size).reshape(-1, bins)
                n[slots, c] = np.bincount(at, minlength=size).reshape(-1, bins)
        return g, n


BLOCKS = "block long, bins binary, y binary, keys binary, models binary, predicted binary"
SPLITS = "model string, tree int, node int, feature string, cut double, gain double, n_rows long, weight double"
Level = Callable[[int, int, np.ndarray, dict[int, Tree]], dict[int, tuple[np.ndarray, np.ndarray]]]


def _grow(p: Params, columns: int, units: Mapping[int, float], level_sums: Level, done: Callable[[int, dict[int, Tree]], None]) -> None:
    for number in range(p.trees):
        drawn = p.drawn(number, columns)
        trees = {m: Tree(p, unit) for m, unit in units.items()}
        for level in range(p.depth):
            growing = {m: t for m, t in trees.items() if len(t.open)}
            if not growing:
                break
            for m, (g, n) in level_sums(number, level, drawn, growing).items():
                growing[m].grow(g, n, drawn, level == p.depth - 1)
        done(number, trees)


def _tree_rows(name: str, number: int, tree: Tree, features: Sequence[str], cuts: Sequence[np.ndarray]) -> list[tuple]:
    """The nodes that a tree has."""
    there = [0]
    for k in there:
        if tree.column[k] >= 0:
            there += [2 * k + 1, 2 * k + 2]
    return [(name, number, k, features[tree.column[k]], float(cuts[tree.column[k]][tree.bin[k]]), float(tree.gain[k]), int(tree.rows[k]), float(tree.weight[k]))
            if tree.column[k] >= 0 else (name, number, k, None, None, 0.0, int(tree.rows[k]), float(tree.weight[k])) for k in there]


def cut_points(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins`` - 1 values of each column at which it may be cut: all but the largest where there are few, else quantiles."""
    shares = [k / bins for k in range(1, bins)]
    out = [np.zeros(0)] * len(columns)
    there = [F.when(~F.isnan(c), F.col(c)) for c in columns]

    def quantiles(ks: Sequence[int]) -> None:
        if ks:
            for k, q in zip(ks, df.agg(*[F.percentile_approx(there[k], shares, 10_000) for k in ks]).first()):
                out[k] = np.unique(np.array(q, float)) if q is not None else out[k]

    distinct = df.agg(*[F.approx_count_distinct(x) for x in there]).first()
    counted = [k for k, n in enumerate(distinct) if n <= 0.9 * bins]
    many = [k for k, n in enumerate(distinct) if n > 0.9 * bins]
    if counted:
        values: dict[int, list[float]] = {k: [] for k in counted}
        long = df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(columns[k]).alias("x")) for k in counted]))).filter("x is not null and not isnan(x)")
        for r in long.distinct().collect():  # about ``bins`` values a column at most
            values[r["k"]].append(r["x"])
        for k, own in values.items():
            if len(own) <= bins:
                out[k] = np.sort(np.array(own, float))[:-1]
            else:
                many.append(k)
    quantiles(many)
    return out


@dataclass
class Booster:
    """Fitted trees of one model."""

    name: str
    features: list[str]
    base: float
    trees: pd.DataFrame  # rows as in SPLITS, in the order of tree and node
    _arrays: tuple | None = field(default=None, repr=False)
    _cuts: list | None = field(default=None, repr=False)
    _tables: list | None = field(default=None, repr=False)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Column (-1: a leaf), cut, weight and rows of each node, by tree; a tree has as many places as the largest needs."""
        if self._arrays is None:
            size = int(self.trees["node"].max()) + 1 if len(self.trees) else 1
            n = int(self.trees["tree"].max()) + 1 if len(self.trees) else 0
            column, cut = np.full((n, size), -1), np.zeros((n, size))
            weight, rows = np.zeros((n, size)), np.zeros((n, size))
            at = self.trees["tree"].to_numpy(), self.trees["node"].to_numpy()
            places = {f: k for k, f in enumerate(self.features)}
            column[at] = [places.get(f, -1) for f in self.trees["feature"]]
            cut[at] = self.trees["cut"].fillna(0.0)
            weight[at], rows[at] = self.trees["weight"], self.trees["n_rows"]
            self._arrays = column, cut, weight, rows
        return self._arrays

    def coded(self, x: np.ndarray) -> list[np.ndarray | None]:
        """For each feature, how many of the cuts that any tree makes in it lie below the rows' values; what isn't up to a cut (NaN too) lies beyond all."""
        return [np.searchsorted(cuts, np.ascontiguousarray(x[:, k])).astype(np.intp) if len(cuts) else None for k, cuts in enumerate(self.cuts())]

    def cuts(self) -> list[np.ndarray]:
        """All cuts of each feature, in order."""
        if self._cuts is None:
            column, cut, _, _ = self.arrays()
            self._cuts = [np.unique(cut[column == k]) for k in range(len(self.features))]
        return self._cuts

    def leaf_tables(self) -> list[tuple[list[tuple[int, np.ndarray]], np.ndarray]]:
        """For each tree of up to 64 leaves: by feature and code, a bit for each leaf, from the left, that the value leaves open; the leaves' weights."""
        if self._tables is None:
            self._tables = []
            column, cut, weight, _ = self.arrays()
            for c, t, w in zip(column, cut, weight):
                weights, splits = [], []

                def walk(node):
                    first = len(weights)
                    if c[node] < 0:
                        weights.append(w[node])
                        return
                    walk(2 * node + 1)
                    splits.append((int(c[node]), int(np.searchsorted(self._cuts[c[node]], t[node])), ~((1 << len(weights)) - (1 << first)) & (1 << 64) - 1))
                    walk(2 * node + 2)

                self.cuts()
                walk(0)
                masks = {}
                for f, k, mask in splits:
                    own = masks.setdefault(f, np.full(len(self._cuts[f]) + 1, (1 << 64) - 1, np.uint64))
                    own[k + 1:] &= np.uint64(mask)
                self._tables.append((list(masks.items()), np.array(weights)))
        return self._tables

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Base and leaf weights of rows of inputs, summed in the order of trees; what isn't up to a cut (NaN too) goes right."""
        column, cut, weight, _ = self.arrays()
        out = np.full(len(x), self.base)
        if column.shape[1] > 127:  # more than 64 leaves
            rows = np.arange(len(x))
            for c, t, w in zip(column, cut, weight):
                place = np.zeros(len(x), np.int64)
                live = rows
                while len(live):
                    here = place[live]
                    inner = c[here] >= 0
                    live, here = live[inner], here[inner]
                    place[live] = 2 * here + 2 - (x[live, c[here]] <= t[here])
                out += w[place]
            return out
        codes = self.coded(x)
        for masks, weights in self.leaf_tables():
            if not masks:
                out += weights[0]
                continue
            left = None
            for f, mask in masks:
                own = mask.take(codes[f], mode="clip")
                left = own if left is None else np.bitwise_and(left, own, out=left)
            left &= np.uint64(0) - left  # the first leaf that all leave open
            out += weights.take((left.astype(np.float64).view(np.int64) >> 52) - 1023, mode="clip")
        return out

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the prediction from its columns; NULL inputs count as 0, as in the matrix that was fitted."""
        model = Booster(self.name, self.features, self.base, self.trees)

        @F.pandas_udf("double")
        def run(inputs: pd.DataFrame) -> pd.Series:
            return pd.Series(model.predict(inputs.to_numpy(np.float64)))

        filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in self.features]
        return df.withColumn(name, run(F.struct(*filled)))

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes of all trees, as ``SPLITS``."""
        rows = [tuple(None if pd.isna(v) else v for v in r) for r in self.trees.itertuples(index=False, name=None)]
        return spark.createDataFrame(rows, SPLITS)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as two tables under ``path``."""
        head = spark.createDataFrame([(self.name, list(self.features), float(self.base))], "name string, features array<string>, base double")
        head.write.mode("overwrite").parquet(f"{path}/head")
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        head = spark.read.parquet(f"{path}/head").first()
        trees = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
        return cls(head["name"], list(head["features"]), head["base"], trees)

    def gains(self) -> pd.DataFrame:
        """Importance of each feature: the mean gain of its splits, as a share of all features' means; without splits 0."""
        inner = self.trees[self.trees["feature"].notna()]
        mean = inner.groupby("feature")["gain"].mean().reindex(self.features).fillna(0.0)
        total = float(mean.sum())
        n = inner.groupby("feature").size().reindex(self.features).fillna(0).astype("int64")
        return pd.DataFrame({"feature": self.features, "importance": mean.to_numpy() / total if total else 0.0, "splits": n.to_numpy()})


def fit_together(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], parts: Mapping[str, Column],
                 params: Mapping[str, float] | None = None, one_task: int | None = None) -> dict[str, Booster]:
    """A model for each of ``parts``, fitted on the rows for which its condition is true, all from the same passes.

    ``keys`` name a row, for the draws of rows; rows with equal keys are drawn together. Rows whose target is NULL or NaN train nothing, NULL and NaN
    inputs count as 0. A model without rows has no trees and predicts 0. ``df`` is read several times while its bins are made; store it first.
    """
    p = Params.of(params)
    if len(parts) > MOST_MODELS:
        raise ValueError(f"at most {MOST_MODELS} models at once")
    names, features = list(parts), list(features)
    bit = lambda k: F.when(F.coalesce(parts[names[k]], F.lit(False)), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    models = bit(0)
    for k in range(1, len(names)):
        models = models.bitwiseOR(bit(k))
    inputs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(features)]
    y = F.col(target).cast("double")
    data = df.filter(y.isNotNull() & ~F.isnan(y)).select(*inputs, y.alias("y"), text_hash(p.seed, *[F.col(k) for k in keys]).alias("key"), models.alias("models"))
    columns = [f"x{k}" for k in range(len(features))]
    has = lambda k: F.col("models").bitwiseAND(F.lit(1 << k)) != 0
    facts = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.when(has(k), F.col("y"))).alias(f"mean_{k}") for k in range(len(names))],
                     F.max(F.abs("y")).alias("most")).first()
    bases = [round(facts[f"mean_{k}"], 6) if facts[f"mean_{k}"] is not None else None for k in range(len(names))]
    cuts = cut_points(data, columns, p.bins)
    # four times the widest gradient of all rows fits 52 bits
    room = 52 - np.log2(max(1, facts["n"]) * max(float(facts["most"] or 0), 1e-9) * 8)
    unit = 2.0 ** -min(UNIT_BITS, int(np.floor(room)))
    units = {k: unit for k, b in enumerate(bases) if b is not None}

    def pack(frames):
        for frame in frames:
            for a in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[a:a + BLOCK_ROWS]
                bins = np.stack([np.searchsorted(own, part[c].to_numpy(float)).astype(np.uint8) for c, own in zip(columns, cuts)])
                first = np.repeat(np.array([b or 0.0 for b in bases])[:, None], len(part), axis=1)
                yield pd.DataFrame([(int(part["key"].iloc[0]), bins.tobytes(), part["y"].to_numpy(float).tobytes(), part["key"].to_numpy(np.int64).tobytes(),
                                     part["models"].to_numpy(np.int64).tobytes(), first.tobytes())], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    blocks, seen = stored_with(data.mapInPandas(pack, BLOCKS), "blocks", n=F.sum(F.length("y") / 8))
    n = int(seen["n"] or 0)
    rows: list[tuple] = []
    if n <= (ONE_TASK if one_task is None else one_task):
        grown = _in_tasks(blocks, p, len(features), units, names, features, cuts, len(names))
    elif tasks := _held_tasks(df.sparkSession, n, len(features), len(names)):
        grown = _in_held_rows(blocks, p, len(features), units, names, features, cuts, len(names), tasks)
    else:
        for number, trees in _over_blocks(blocks, p, len(features), units, len(names)):
            for m, tree in trees.items():
                rows += _tree_rows(names[m], number, tree, features, cuts)
        grown = pd.DataFrame(rows, columns=[c.split()[0] for c in SPLITS.split(", ")])
    grown = grown.sort_values(["model", "tree", "node"]).astype({"model": object, "tree": "int64", "node": "int64", "feature": object, "cut": float, "n_rows": "int64"})
    grown["feature"] = grown["feature"].where(grown["feature"].notna(), None)
    return {name: Booster(name, features, bases[k] or 0.0, grown[grown["model"] == name].reset_index(drop=True)) for k, name in enumerate(names)}


def _in_tasks(blocks: DataFrame, p: Params, columns: int, units, names, features, cuts, models: int) -> pd.DataFrame:
    """Each model from all blocks in one task."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        m, rows = int(frame["model"].iloc[0]), []
        block = Block.joined([Block.read(r, columns, models) for r in frame.itertuples(index=False)])

        def done(number: int, trees: dict[int, Tree]) -> None:
            rows.extend(_tree_rows(names[m], number, trees[m], features, cuts))
            block.add(m, trees[m], number)

        _grow(p, columns, {m: units[m]}, lambda number, level, drawn, trees: {m: block.sums(m, number, trees[m], level, drawn)}, done)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SPLITS.split(", ")])

    each = F.explode(F.array(*[F.lit(m) for m in units])) if units else F.explode(F.array().cast("array<int>"))
    return blocks.withColumn("model", each).groupBy("model").applyInPandas(run, SPLITS).toPandas()


class Meeting:
    """Tasks that run at the same time add up their arrays by files in a shared folder; all get the same sums."""

    def __init__(self, folder: str, own: int, tasks: int):
        self.folder, self.own, self.tasks, self.step = folder, own, tasks, 0
        os.makedirs(folder, exist_ok=True)

    def total(self, arrays: Sequence[np.ndarray]) -> list[np.ndarray]:
        name = lambda task, step: f"{self.folder}/{step}-{task}"
        with open(f"{name(self.own, self.step)}.new", "wb") as f:
            for a in arrays:
                f.write(np.ascontiguousarray(a))
        os.rename(f"{name(self.own, self.step)}.new", name(self.own, self.step))
        out = [a.copy() for a in arrays]
        for other in range(self.tasks):
            if other == self.own:
                continue
            while not os.path.exists(name(other, self.step)):
                time.sleep(0.001)
            with open(name(other, self.step), "rb") as f:
                for a in out:
                    a += np.frombuffer(f.read(a.nbytes), a.dtype).reshape(a.shape)
        if self.step:  # whoever has written this step has read the one before
            os.remove(name(self.own, self.step - 1))
        self.step += 1
        return out


def _held_tasks(spark: SparkSession, rows: int, columns: int, models: int) -> int:
    """How many tasks may hold all rows at once; 0 if they can't, or if tasks have no folder in common that Python can write."""
    context = spark.sparkContext._jsc.sc()
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    files, _ = file_system(spark, shared_dir(spark))
    if files.getUri().getScheme() != "file":
        return 0
    tasks = min(HELD_TASKS, int(context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())))
    return tasks if tasks and rows / tasks * (2 * columns + 40 + 40 * models) <= HELD_BYTES else 0


def _in_held_rows(blocks: DataFrame, p: Params, columns: int, units, names, features, cuts, models: int, tasks: int) -> pd.DataFrame:
    """All models from one pass: tasks that run together keep their rows, and add up the sums of each level."""
    spark = blocks.sparkSession
    files, place = file_system(spark, scratch_path(spark, "sums"))
    folder = place.toUri().getPath()

    def run(frames):
        context = BarrierTaskContext.get()
        own = [Block.read(r, columns, models) for frame in frames for r in frame.itertuples(index=False)]
        none = Block(np.zeros((columns, 0), np.uint8), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((models, 0)))
        block = Block.joined(own) if own else none
        own.clear()
        attempt = context.allGather(uuid.uuid4().hex)[0]  # a stage that begins again meets elsewhere
        meeting = Meeting(f"{folder}/{attempt}", context.partitionId(), tasks)
        rows: list[tuple] = []

        def level_sums(number, level, drawn, growing):
            used = np.arange(p.bins) < np.array([len(cuts[c]) + 1 for c in drawn])[:, None]
            found = {m: block.sums(m, number, tree, level, drawn) for m, tree in growing.items()}
            totals = iter(meeting.total([a for g, n in found.values() for a in (g[:, used], n[:, used].astype(np.int32))]))
            out = {}
            for m, (g, n) in found.items():
                g[:, used], n[:, used] = next(totals), next(totals)
                out[m] = g, n
            return out

        def done(number, trees):
            for m, tree in trees.items():
                block.add(m, tree, number)
                if not meeting.own:
                    rows.extend(_tree_rows(names[m], number, tree, features, cuts))

        _grow(p, columns, units, level_sums, done)
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SPLITS.split(", ")])

    try:
        return blocks.repartition(tasks).mapInPandas(run, SPLITS, barrier=True).toPandas()
    finally:
        files.delete(place, True)


SUMS = "model int, at int, g long, n long"


def _over_blocks(blocks: DataFrame, p: Params, columns: int, units: Mapping[int, float], models: int):
    """The trees in turn, all models' sums of a level from one pass over the blocks."""
    waiting: list[dict[int, Tree]] = []
    out: list[tuple[int, dict[int, Tree]]] = []
    state = {"blocks": blocks}

    def level_sums(number, level, drawn, growing):
        before, trees = list(waiting), {m: t.lean() for m, t in growing.items()}

        def run(frames):
            totals: dict[int, list[np.ndarray]] = {}
            for frame in frames:
                for row in frame.itertuples(index=False):
                    block = Block.read(row, columns, models)
                    for done in before:
                        for m, tree in done.items():
                            block.add(m, tree)
                    for m, tree in trees.items():
                        own = block.sums(m, number, tree, level, drawn)
                        totals[m] = [a + b for a, b in zip(totals[m], own)] if m in totals else list(own)
            for m, (g, n) in totals.items():
                at = np.flatnonzero(n.ravel())
                yield pd.DataFrame({"model": m, "at": at, "g": g.ravel()[at].astype(np.int64), "n": n.ravel()[at].astype(np.int64)})

        # at most models x nodes x columns x bins rows come back
        found = state["blocks"].mapInPandas(run, SUMS).groupBy("model", "at").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas()
        sums = {}
        for m, tree in trees.items():
            own = found[found["model"] == m]
            shape = (len(tree.counted), len(drawn), p.bins)
            g, n = np.zeros(np.prod(shape)), np.zeros(np.prod(shape))
            g[own["at"]], n[own["at"]] = own["g"], own["n"]
            sums[m] = g.reshape(shape), n.reshape(shape)
        return sums

    def done(number: int, trees: dict[int, Tree]) -> None:
        trees = {m: t.lean() for m, t in trees.items()}
        out.append((number, trees))
        waiting.append(trees)
        if len(waiting) == STORE_EVERY:
            finished = list(waiting)
            waiting.clear()

            def advance(frames):
                for frame in frames:
                    for row in frame.itertuples(index=False):
                        block = Block.read(row, columns, models)
                        for each in finished:
                            for m, tree in each.items():
                                block.add(m, tree)
                        yield pd.DataFrame([(row.block, row.bins, row.y, row.keys, row.models, block.predicted.tobytes())], columns=list(frame.columns))

            state["blocks"] = stored(state["blocks"].mapInPandas(advance, BLOCKS), "blocks")

    _grow(p, columns, units, level_sums, done)
    return out


def fit(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], params: Mapping[str, float] | None = None, name: str = "model") -> Booster:
    """One model on all rows; see ``fit_together``."""
    return fit_together(df, features, target, keys, {name: F.lit(True)}, params)[name]


def predict_by(df: DataFrame, models: Mapping[int, Booster], column: str, name: str = "prediction") -> DataFrame:
    """``df`` with each row's prediction by the model that ``column`` names; NULL where it names none."""
    features = next(iter(models.values())).features
    lean = {k: Booster(m.name, m.features, m.base, m.trees) for k, m in models.items()}

    @F.pandas_udf("double")
    def run(inputs: pd.DataFrame) -> pd.Series:
        which, x = inputs["which"].to_numpy(float), inputs[features].to_numpy(np.float64)
        out = np.full(len(x), np.nan)
        for k, model in lean.items():
            own = which == k
            out[own] = model.predict(x[own])
        return pd.Series(out)

    filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in features]
    return df.withColumn(name, F.when(F.col(column).isin(*models), run(F.struct(*filled, F.col(column).cast("double").alias("which")))))
