"""Near-duplicate embeddings by an inverted file with product quantisation.

Coarse centroids make the lists. A member keeps the codes of its residual in each subspace and how far
they are from it, so a table lookup gives a lower bound of its distance to any asking vector; members that the
bound leaves are compared exactly. A vector asks its own list and those whose border it is near.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import connected_components, merge_labels, spread_work
from annualis.session import stored, stored_with

COSINE = 0.95
MARGIN = 0.12  # distance from a list's border within which the list is asked
SAMPLE = 16_384  # vectors that centroids and codebooks are fitted on
MOST_LISTS = 2_048
SUBSPACES, CODES = 8, 256
ROUNDS = 8
MEMBERS, ASKING = 4_096, 16_384
CELLS = 1 << 21


def _squares(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1) - 2 * rows @ centers.T, 0)


def k_means(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([_squares(rows[a:a + 2_048], centers).argmin(axis=1) for a in range(0, len(rows), 2_048)])
        total = np.zeros_like(centers)
        np.add.at(total, near, rows)
        n = np.bincount(near, minlength=len(centers))
        centers[n > 0] = total[n > 0] / n[n > 0, None]
    return centers


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # keeps squares of tiny and huge numbers finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Quantiser:
    """Coarse centroids and, for residuals cut into subspaces, a codebook each."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centers = k_means(sample, lists, 1)
        near = np.concatenate([_squares(sample[a:a + 2_048], self.centers).argmin(axis=1) for a in range(0, len(sample), 2_048)])
        rest = sample - self.centers[near]
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [k_means(rest[:, a:b], CODES, 2 + a) for a, b in zip(self.cuts, self.cuts[1:])]
        self.apart = np.sqrt(_squares(self.centers, self.centers))

    def home_and_probes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector, and a mask of the lists it asks: its own, and later ones whose border is near.

        (d(x, other)^2 - d(x, own)^2) / 2 d(own, other) is x's distance from the plane between two lists.
        """
        squares = _squares(rows, self.centers)
        home = squares.argmin(axis=1)
        own = squares[np.arange(len(rows)), home][:, None]
        near = squares - own <= 2 * MARGIN * self.apart[home]
        return home, near & (np.arange(len(self.centers)) >= home[:, None])

    def encode(self, rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance of each vector from what its codes stand for."""
        rest = rows - self.centers[home]
        codes = np.empty((len(rows), len(self.books)), np.uint8)
        lost = np.zeros(len(rows))
        for m, (a, b, book) in enumerate(zip(self.cuts, self.cuts[1:], self.books)):
            squares = _squares(rest[:, a:b], book)
            codes[:, m] = squares.argmin(axis=1)
            lost += ((rest[:, a:b] - book[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(lost).astype(np.float32)

    def estimates(self, rows: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of asking vectors to what the members' codes stand for, summed from tables."""
        rest = rows - self.centers[at]
        out = np.zeros((len(rows), len(codes)), np.float32)
        for m, (a, b, book) in enumerate(zip(self.cuts, self.cuts[1:], self.books)):
            out += _squares(rest[:, a:b], book).astype(np.float32)[:, codes[:, m]]
        return out


def _vectors(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


ROUTED = "list int, batch long, members long, asking long, own binary, ask binary"


def _router(quantiser: Quantiser):
    """Classes to what they put into each list (class, rows, lost, codes, vector) and ask it (class, rows, inside, vector)."""
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), 1_024):
                part = frame.iloc[a:a + 1_024]
                rows = unit(_vectors(part["embedding"]))
                ids, times = part["cls"].to_numpy(np.int64), part["times"].to_numpy(np.int64)
                home, probes = quantiser.home_and_probes(rows)
                codes, lost = quantiser.encode(rows, home)
                row, to = np.nonzero(probes)
                order = np.argsort(to, kind="stable")
                row, to = row[order], to[order]
                cuts = np.flatnonzero(np.diff(to, prepend=-1))
                out = []
                for k, end in zip(cuts, [*cuts[1:], len(to)]):
                    ask = row[k:end]
                    inside = home[ask] == to[k]
                    own = ask[inside]
                    out.append((int(to[k]), int(ids[0]), len(own), len(ask),
                                _join(ids[own], times[own], lost[own], codes[own], rows[own]),
                                _join(ids[ask], times[ask], inside, rows[ask])))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in ROUTED.split(", ")])

    return run


def _join(*arrays: np.ndarray) -> bytes:
    return np.array([len(arrays[0])], np.int64).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _split(data: list[bytes], kinds: list[tuple]) -> list[np.ndarray]:
    """Fields of joined records, of all of ``data``; a kind is a type and a width."""
    out = [[] for _ in kinds]
    for d in data:
        n, at = int(np.frombuffer(d, np.int64, 1)[0]), 8
        for field, (kind, width) in zip(out, kinds):
            field.append(np.frombuffer(d, kind, n * width, at).reshape(n, width))
            at += n * width * np.dtype(kind).itemsize
    return [np.concatenate(f) if f else np.zeros((0, w), k) for f, (k, w) in zip(out, kinds)]


PAIRS = "cls long, other long, n long"


def _comparer(quantiser: Quantiser):
    radius = float(np.sqrt(2 - 2 * COSINE)) + 1e-3
    size, width = quantiser.centers.shape[1], len(quantiser.books)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Rows (cls, null, n): links counted; rows (cls, other, 0): a forest of the links."""
        ids, times, lost, codes, rows = _split([x for x in frame["own"] if x], [(np.int64, 1), (np.int64, 1), (np.float32, 1), (np.uint8, width), (np.float64, size)])
        ask_ids, ask_times, inside, asking = _split([x for x in frame["ask"] if x], [(np.int64, 1), (np.int64, 1), (bool, 1), (np.float64, size)])
        ids, times, ask_ids, ask_times, inside = (x[:, 0] for x in (ids, times, ask_ids, ask_times, inside))
        nodes, where = np.unique(np.concatenate([ids, ask_ids]), return_inverse=True)
        own, ask = where[: len(ids)], where[len(ids):]
        label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        bound = (radius + lost[:, 0]) ** 2
        step = max(1, CELLS // max(1, len(ids)))
        for a in range(0, len(ask_ids) if len(ids) else 0, step):
            part = asking[a:a + step]
            i, j = np.nonzero(quantiser.estimates(part, int(frame["list"].iloc[0]), codes) <= bound)
            once = ~inside[a + i] | (ask_ids[a + i] < ids[j])
            i, j = i[once], j[once]
            for b in range(0, len(i), 1 << 15):
                x, y = i[b:b + (1 << 15)], j[b:b + (1 << 15)]
                linked = np.einsum("ij,ij->i", part[x], rows[y]) >= COSINE
                x, y = x[linked], y[linked]
                np.add.at(links, ask[a + x], times[y])
                np.add.at(links, own[y], ask_times[a + x])
                label = merge_labels(label, ask[a + x], own[y])
        some, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(nodes)))
        counted = pd.DataFrame({"cls": nodes[some], "other": pd.array([None] * len(some), "Int64"), "n": links[some]})
        forest = pd.DataFrame({"cls": nodes[moved], "other": pd.array(nodes[label[moved]], "Int64"), "n": 0})
        return pd.concat([counted, forest])

    return run


def embedding_links(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding).

    Rows are linked at a cosine of ``COSINE`` or more. Equal vectors are one class, whose rows are linked
    with each other; classes are compared. ``component_id`` is the smallest vec_id that links reach, ``kept`` whether
    it is the row's own. Vectors that are null, empty, zero, hold nulls or numbers that aren't finite, or are not as long as
    most, have no link. A null vec_id isn't a component's name unless it has no other, and isn't kept. Other columns don't matter.
    """
    data = vectors.select("vec_id", "embedding")
    sound = (F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    common = data.filter(sound).groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    alone = data.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.coalesce(F.col("vec_id").isNotNull(), F.lit(False)).alias("kept"))
    if not common:
        return alone
    usable = F.coalesce(sound & (F.size("embedding") == common["n"]), F.lit(False))
    classes = (data.filter(usable).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("times"))
               .withColumn("cls", F.monotonically_increasing_id()))
    classes, seen = stored_with(classes, "vectors", n=F.count(F.lit(1)))
    sample = [r["embedding"] for r in classes.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).collect()]
    lists = max(1, min(MOST_LISTS, int(4 * np.sqrt(seen["n"])), len(sample) // 8))
    quantiser = Quantiser(unit(_vectors(sample)), lists)
    routed = stored(classes.select("cls", "times", "embedding").mapInPandas(_router(quantiser), ROUTED), "routed")
    found = stored(spread_work(routed, MEMBERS, ASKING).groupBy("list", "block", "turn").applyInPandas(_comparer(quantiser), PAIRS), "links")
    counts = found.filter("other is null").groupBy("cls").agg(F.sum("n").alias("n"))
    joined = connected_components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    rooted = (classes.join(counts, "cls", "left").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
              .select("embedding", "first", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "cls").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(lowest, "root").select("embedding", "n_links", "component_id"), "named")
    linked = data.filter(usable).join(named, "embedding").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    rest = data.filter(~usable).select("vec_id").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    return linked.unionAll(rest)
