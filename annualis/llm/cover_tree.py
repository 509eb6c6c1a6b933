"""Hard negatives by cover trees: rows of another label whose score lies in a window below that of a positive.

One more component makes all candidates equally long. Candidates are dealt by label and by the nearest of a few centers to blocks of bounded
size, and each block becomes a cover tree: nets of centers taken farthest first, each level's centers farther apart than its scale and covering all
points below it. A node's covering radius bounds the inner products of all its points from both sides. The queries of a task go down together,
skip nodes outside every window that is still open, take the leaves of the highest bounds first and compare the points of a leaf exactly, all
queries that come to it at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import tidy
from annualis.llm.vectors import (FOUND, digest, farthest_first, first_by_key, first_of_equals, ids_and_nulls, in_blocks, matrix, met, pack,
                                  products, sampled, squares, unpack, unpack_all, whole)
from annualis.session import attach, stored, stored_with

CENTERS = 16  # cells for each bucket of labels at most
LABELS = 16  # buckets of labels
CELL_MEMBERS = 4_096 * LABELS
MEMBERS, ASKING = 4_096, 512
LEAF = 64  # points of a leaf on average
BATCH = 1_024
AT_ONCE = 1 << 18  # scores that are held at once
SLACK = 1e-6
LOWEST = np.iinfo(np.int64).min


class CoverTree:
    """Nested nets over some rows; see ``build``."""

    def __init__(self, arrays: list[np.ndarray]):
        (self.rows, self.ids, self.nulls, self.number, self.labels, self.begin, self.end, self.center, self.radius, self.first_child, self.last_child,
         self.longest) = arrays

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray, nulls: np.ndarray, number: np.ndarray, labels: np.ndarray, longest: float) -> CoverTree:
        """Levels halve the scale until all centers are in the net; each point is below its nearest center, each center below the nearest of the level above.

        Nodes are in the order of levels, the children of a node side by side; a node's points are ``begin`` to ``end``.
        """
        extra = np.sqrt(np.maximum(longest - squares(rows).astype(np.float64), 0))
        chosen, gaps, far = farthest_first(rows, extra, max(1, -(-len(rows) // LEAF)))
        scale = gaps[1] if len(gaps) > 1 else 0.0
        nets = [1]
        while nets[-1] < len(chosen):
            scale /= 2
            n = int((gaps > scale).sum())
            if n > nets[-1]:
                nets.append(n)
        above = []  # for each level but the first, the node of the level above over each of its centers
        for small, large in zip(nets, nets[1:]):
            over = far[:small, chosen[:large]].argmin(axis=0)
            over[:small] = np.arange(small)
            above.append(over)
        leaf = far.argmin(axis=0)
        paths = [leaf]  # the node over each point, from the last level up
        for over in reversed(above):
            paths.append(over[paths[-1]])
        paths.reverse()
        order = np.lexsort(paths[::-1])
        begin, end, center, radius, counts, parents = [], [], [], [], [], []
        for level, path in enumerate(paths):
            own = path[order]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            begin.append(heads)
            end.append(np.append(heads[1:], len(own)))
            center.append(chosen[own[heads]])
            radius.append(np.maximum.reduceat(far[path, np.arange(len(path))][order], heads))
            counts.append(len(heads))
            parents.append(np.searchsorted(begin[level - 1], heads, "right") - 1 if level else np.zeros(1, np.int64))
        offset = np.cumsum([0, *counts])
        first, last = np.zeros(offset[-1], np.int64), np.zeros(offset[-1], np.int64)
        for level in range(1, len(paths)):
            n = np.bincount(parents[level], minlength=counts[level - 1])
            upto = offset[level] + np.cumsum(n)
            first[offset[level - 1]:offset[level]], last[offset[level - 1]:offset[level]] = upto - n, upto
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        return cls([rows[order], ids[order], nulls[order], number[order], labels[order], np.concatenate(begin), np.concatenate(end),
                    place[np.concatenate(center)], np.concatenate(radius), first, last, np.array([longest])])

    def packed(self) -> bytes:
        return pack(self.rows, self.ids, self.nulls, self.number, self.labels, self.begin, self.end, self.center, self.radius, self.first_child, self.last_child,
                    self.longest)

    def bounds(self, queries: np.ndarray, nodes: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """The least and the highest score of any point of each node, for each query: by the distance of its center, and by its radius alone."""
        inner = products(queries, self.rows[self.center[nodes]]).astype(np.float64)
        longest = float(self.longest[0])
        size = squares(queries).astype(np.float64)[:, None]
        length = np.sqrt(size)
        radius = self.radius[nodes] * (1 + SLACK) + SLACK * (longest**0.5 + 1)
        apart = np.sqrt(np.maximum(size + longest - 2 * inner, 0))
        whole = size + longest
        high = np.minimum(inner + length * radius, (whole - np.maximum(apart - radius, 0) ** 2) / 2)
        low = np.maximum(inner - length * radius, (whole - (apart + radius) ** 2) / 2)
        room = 1e-9 * whole + 1e-6
        return low - room, high + room

    def leaves(self, queries: np.ndarray, asked: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaves, low, high): the leaves that some window is open for, and each query's bounds of them, no wider than those of the nodes above.

        The queries go down together, a level at a time; what is below a node outside all windows is not looked at.
        """
        nodes = np.zeros(1, np.int64)
        low, high = self.bounds(queries, nodes)
        while True:
            some = np.flatnonzero(asked.open(low, high).any(axis=0))
            nodes, low, high = nodes[some], low[:, some], high[:, some]
            n = self.last_child[nodes] - self.first_child[nodes]
            if not n.any():  # all leaves are on the last level
                return nodes, low, high
            above = np.repeat(np.arange(len(nodes)), n)
            nodes = self.first_child[nodes][above] + np.arange(len(above)) - (np.cumsum(n) - n)[above]
            own_low, own_high = self.bounds(queries, nodes)
            low, high = np.maximum(low[:, above], own_low), np.minimum(high[:, above], own_high)

    def search(self, queries: np.ndarray, labels: np.ndarray, others: bool, asked: Windows, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first ``n`` points in each window, of the query's label or of ``others``: windows, places in ``rows`` and scores, side by side.

        Queries that come to the same leaf are compared with its points at once. In each round a query takes twice as many of its open leaves
        as in the one before, or more if bounds are equal, those of the highest bounds first; what is found closes leaves for the rounds after it.
        """
        found = np.zeros((3, 0), np.int64)

        def kept(fresh: list[np.ndarray]) -> np.ndarray:
            window, at, value = np.concatenate([found, *fresh], axis=1)
            order = np.lexsort((self.number[at], self.ids[at], self.nulls[at], -value, window))
            window, at, value = window[order], at[order], value[order]
            nth = np.arange(len(window)) - np.searchsorted(window, window)
            full = nth == n - 1
            asked.raise_to(window[full], value[full])
            return np.stack([window, at, value])[:, nth < n]

        leaves, low, high = self.leaves(queries, asked)
        left, step = np.ones(high.shape, bool), 1
        while True:
            left &= asked.open(low, high)
            if not left.any():
                return found[0], found[1], found[2]
            best = np.where(left, np.minimum(high, asked.top[:, None]), -np.inf)
            taken = left & (best >= -np.partition(-best, min(step, len(leaves)) - 1, axis=1)[:, [min(step, len(leaves)) - 1]])
            left &= ~taken
            fresh, waiting = [], 0
            for k in np.flatnonzero(taken.any(axis=0)):
                a, b = self.begin[leaves[k]], self.end[leaves[k]]
                some = np.flatnonzero(taken[:, k])
                for part in np.array_split(some, -(-len(some) * (b - a) // AT_ONCE)):
                    scores = products(queries[part], self.rows[a:b])
                    hit = np.flatnonzero(scores >= asked.least[part, None])
                    query, at = part[hit // (b - a)], a + hit % (b - a)
                    fits = (self.labels[at] != labels[query]) == others
                    fresh.append(asked.of(query[fits], at[fits], scores.ravel()[hit[fits]]))
                    waiting += fresh[-1].shape[1]
                    if waiting > AT_ONCE:
                        found, fresh, waiting = kept(fresh), [], 0
            found = kept(fresh)
            step *= 2


class Windows:
    """Windows (least, most, least that is of use) of scores, those of a query side by side; ``need`` rises with what is found.

    ``least`` and ``top`` hold all windows of a query.
    """

    def __init__(self, sizes: np.ndarray, edges: np.ndarray):
        """``sizes`` tells how many windows each query has, one at least."""
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.need, self.most = np.maximum(edges[:, 0], edges[:, 2]), edges[:, 1]
        self.least, self.top = np.minimum.reduceat(self.need, self.first), np.maximum.reduceat(self.most, self.first)

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a score from ``low`` to ``high`` may be of use to a query, for each query and node."""
        return np.logical_or.reduceat((high[self.owner] >= self.need[:, None]) & (low[self.owner] <= self.most[:, None]), self.first, axis=0)

    def of(self, query: np.ndarray, at: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Scores of queries as (window, place, score) for each window that holds them."""
        n = self.sizes[query]
        each = np.repeat(np.arange(len(query)), n)
        window = self.first[query][each] + np.arange(len(each)) - (np.cumsum(n) - n)[each]
        own = (score[each] >= self.need[window]) & (score[each] <= self.most[window])
        return np.stack([window, at[each], score[each]])[:, own]

    def raise_to(self, window: np.ndarray, score: np.ndarray) -> None:
        self.need[window] = np.maximum(self.need[window], score)
        self.least = np.minimum.reduceat(self.need, self.first)


class Sample:
    """A bounded sample of candidates: centers of the cells, and scores that some of them reach already."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, longest: int, cells: int):
        self.rows, self.labels, self.longest = rows, labels, float(longest)
        extra = np.sqrt(np.maximum(self.longest - squares(rows).astype(np.float64), 0))
        chosen, _, _ = farthest_first(rows, extra, cells)
        self.centers, self.extra = rows[chosen], extra[chosen]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest - squares(rows).astype(np.float64), 0))
        return (products(rows, self.centers) + extra[:, None] * self.extra).argmax(axis=1)  # of equal lengths, so this is the nearest

    def reached(self, scores: np.ndarray, fits: np.ndarray, low: int, high: int, n: int) -> int:
        """A score that ``n`` fitting candidates of a window reach at least."""
        own = scores[fits & (scores >= low) & (scores <= high)]
        return int(np.partition(own, len(own) - n)[len(own) - n]) if len(own) >= n else LOWEST


def label_bucket(labels: np.ndarray) -> np.ndarray:
    return labels % LABELS


def _dealt(sample: Sample, width: int):
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), BATCH):
                part = frame.iloc[a:a + BATCH]
                rows, labels = matrix(part["vector"], width), part["label"].to_numpy(np.int64)
                ids, nulls = ids_and_nulls(part["vec_id"])
                number = part["row"].to_numpy(np.int64)
                to = label_bucket(labels) * CENTERS + sample.cells(rows)
                out = []
                for k in np.unique(to):
                    own = to == k
                    out.append((int(k), int(number[0]), int(own.sum()), pack(rows[own], ids[own], nulls[own], number[own], labels[own])))
                yield pd.DataFrame(out, columns=["list", "batch", "n", "own"])

    return run


def _planted(longest: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tree = CoverTree.build(*unpack_all(frame["own"]), longest)
        return pd.DataFrame([(int(frame["list"].iloc[0]), int(frame["block"].iloc[0]), tree.packed())], columns=["list", "block", "own"])

    return run


ASKED = "list int, batch long, n long, ask binary"


def _ask(sample: Sample, width: int, lists: list[int], n: int, others: bool):
    """Queries (key, vector, label, and bounds of windows: lows, highs) to what they ask the lists that may hold fitting labels.

    Sent are key, vector, label, how many windows, and for each its least and highest score and a score that ``n`` rows reach.
    """
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), BATCH):
                part = frame.iloc[a:a + BATCH]
                rows, labels = matrix(part["vector"], width), part["label"].to_numpy(np.int64)
                keys = np.array(part["key"].tolist(), "S32")
                scores, windows = products(rows, sample.rows), []
                for k, (lows, highs) in enumerate(zip(part["lows"], part["highs"])):
                    fits = (sample.labels != labels[k]) == others
                    windows.append([(x, y, sample.reached(scores[k], fits, x, y, n)) for x, y in zip(lows, highs)])
                sizes = np.array([len(w) for w in windows], np.int64)
                bucket, out = label_bucket(labels), []
                for to in lists:
                    some = np.flatnonzero(sizes > 0) if others else np.flatnonzero((bucket == to // CENTERS) & (sizes > 0))
                    if len(some):
                        edges = np.array([w for k in some for w in windows[k]], np.int64)
                        out.append((to, int(part["row"].iloc[0]), len(some), pack(keys[some], rows[some], labels[some], sizes[some], edges)))
                yield pd.DataFrame(out, columns=["list", "batch", "n", "ask"])

    return run


WINDOWED = f"{FOUND}, low long, high long"


def _mine(n: int, others: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """One tree's first rows for each window of the queries of a turn."""
        tree = CoverTree(unpack(next(x for x in frame["own"] if x)))
        asks = [x for x in frame["ask"] if x]
        if not asks:
            return pd.DataFrame(columns=["key", "vec_id", "row", "score", "low", "high"])
        names, queries, labels, sizes, edges = unpack_all(asks)
        asked = Windows(sizes, edges)
        window, places, scores = tree.search(queries, labels, others, asked, n)
        keys = pd.Series([k.decode() for k in names[asked.owner[window]].tolist()], dtype=object)
        return pd.DataFrame({"key": keys, "vec_id": pd.Series(tree.ids[places], dtype="Int64").mask(tree.nulls[places]), "row": tree.number[places],
                             "score": scores, "low": edges[window, 0], "high": edges[window, 1]})

    return run


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor's positives and their hard negatives.

    ``rows`` has vec_id (long), vector (array of long) and label (whole number); rows with a null vector or label take no part. Anchors
    are rows for which ``anchors`` is true. Positives are an anchor's ``positives`` first other rows of its label by falling inner product; for each
    come the ``negatives`` first rows of other labels with ``low`` to ``high`` percent of the positive's score (a window that
    is empty below zero). Ties come by vec_id, nulls last. Rows with the same vec_id are rows of their own; shorter vectors count as ending
    in zeros. Equal rows are searched once, and only as many of them are kept as can be found. Other columns don't matter.
    """
    sound = F.col("vector").isNotNull() & F.col("label").isNotNull()
    rows = stored(rows.filter(sound).select("vec_id", "vector", F.col("label").cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"))
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    size = F.aggregate("vector", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    facts = {"n": F.count(F.lit(1)), "width": F.max(F.size("vector")), "longest": F.max(size)}
    kept = max(positives + 1, negatives)
    candidates, seen = stored_with(first_of_equals(rows.select("vec_id", "row", "label", "vector"), ["vector", "label"], kept), "candidates", **facts)
    if not seen["n"]:
        return rows.sparkSession.createDataFrame([], kinds)
    width = seen["width"]
    some = sampled(candidates, ["vector", "label", "row"], width)
    sample = Sample(matrix([r["vector"] for r in some], width), np.array([r["label"] for r in some], np.int64), seen["longest"],
                    max(1, min(CENTERS, -(-seen["n"] // CELL_MEMBERS))))
    members = stored(candidates.mapInPandas(tidy(_dealt(sample, width)), "list int, batch long, n long, own binary"), "cells")
    trees = stored(in_blocks(members, MEMBERS).select("list", "block", "own").groupBy("list", "block")
                   .applyInPandas(tidy(_planted(float(seen["longest"]))), "list int, block long, own binary"), "trees")
    lists = sorted(r["list"] for r in trees.select("list").distinct().collect())  # LABELS * CENTERS at most

    def search(asking: DataFrame, n: int, others: bool) -> DataFrame:
        asked = stored(asking.mapInPandas(tidy(_ask(sample, width, lists, n, others)), ASKED), "asked")
        return met(trees, asked, ASKING).groupBy("list", "block", "turn").applyInPandas(tidy(_mine(n, others)), WINDOWED)

    queries = stored(rows.filter("asks").select("vec_id", "row", digest("vector", "label").alias("key"), "vector", "label"), "anchors")
    classes = queries.groupBy("key").agg(F.first("vector").alias("vector"), F.first("label").alias("label"), F.min("row").alias("row"))
    edge = lambda x: F.array(F.lit(int(x)).cast("long"))
    classes = stored(classes.withColumns({"lows": edge(LOWEST), "highs": edge(np.iinfo(np.int64).max)}), "classes")
    near = stored(first_by_key(search(classes, positives + 1, False), positives + 1), "positives")
    # with p = 100 m + r the window's edges are m and a share of r, so no product leaves a long
    rest = lambda p: F.pmod(p, F.lit(100))
    hundreds = lambda p: F.call_function("div", p - rest(p), F.lit(100))
    window = lambda p: F.struct((hundreds(p) * low + F.ceil(rest(p) * low / 100)).cast("long").alias("low"),
                                (hundreds(p) * high + F.floor(rest(p) * high / 100)).cast("long").alias("high"))
    scores = F.array_distinct(F.transform("top", lambda x: x["score"]))
    windows = F.filter(F.array_distinct(F.transform(scores, window)), lambda w: w["low"] <= w["high"])
    asking = (classes.drop("lows", "highs").join(near, "key").withColumn("windows", windows)
              .select("key", "row", "vector", "label", F.transform("windows", lambda w: w["low"]).alias("lows"), F.transform("windows", lambda w: w["high"]).alias("highs")))
    far = first_by_key(search(asking, negatives, True), negatives, "low", "high")
    by_key = far.groupBy("key").agg(F.collect_list(F.struct("low", "high", "top")).alias("far"))
    finds = attach(queries.select("key", F.col("vec_id").alias("anchor_id"), "row"), near.join(by_key, "key"), ["key"], "finds")
    others = F.slice(F.filter("top", lambda x: x["row"] != F.col("row")), 1, positives)
    pairs = finds.select("anchor_id", "far", F.explode(others).alias("positive")).withColumn("window", window(F.col("positive.score")))
    own = F.filter("far", lambda x: (x["low"] == F.col("window.low")) & (x["high"] == F.col("window.high")))
    pairs = pairs.select("anchor_id", "positive", F.explode(F.flatten(F.transform(own, lambda x: x["top"]))).alias("negative"))
    return pairs.select("anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("negative.nth").cast("int").alias("rank"),
                        F.col("negative.vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
                        F.col("negative.score").alias("negative_score"))


def embedding_negatives(vectors: DataFrame, every: int = 50, moved: int = 7, classes: int = 10) -> DataFrame:
    """``hard_negatives`` of the embeddings (vec_id, embedding, label) as whole numbers floor(256 x).

    Rows whose vec_id ``moved`` divides first get the next of ``classes`` labels; anchors are rows whose vec_id ``every`` divides.
    """
    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", whole("embedding").alias("vector"), label.alias("label")), F.col("vec_id") % every == 0)
