"""Exact top-k by inner product with a table of distances to pivots.

One more component gives all candidates the same length, so the highest inner products are the smallest distances from a query.
The table holds each candidate's distances to many pivots; by the triangle inequality the greatest difference from the query's own is a lower
bound of their distance. A task evaluates its candidates in the order of their bounds and stops when the next bound can't reach
the k-th score. Candidates lie in the list of the nearest pivot, and a query asks the lists whose radius lets them reach a score that a
bounded sample of candidates already has.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import tidy
from annualis.llm.vectors import (FOUND, digest, farthest_first, first_by_key, first_of_equals, ids_and_nulls, in_blocks, matrix, met, pack,
                                  products, ranked, sampled, squares, unpack, unpack_all, whole)
from annualis.session import attach, stored, stored_with

PIVOTS = 64
LIST_MEMBERS = 4_096  # candidates for each list, while there are pivots left
MEMBERS, ASKING = 4_096, 1_024  # of a block and of a turn
BATCH = 1_024
FIRST = 64  # candidates evaluated before the first stop is tried; then twice as many each time
SLACK = 1e-6  # of the lengths, far above the rounding of distances


class Pivots:
    """Pivots among the sampled candidates, and the sample itself for first thresholds."""

    def __init__(self, sample: np.ndarray, longest: int, lists: int, k: int):
        self.sample, self.longest, self.k = sample, float(longest), k
        extra = self.extra(squares(sample))
        chosen, _, _ = farthest_first(sample, extra, PIVOTS)
        self.rows, self.own = sample[chosen], extra[chosen]
        self.lists = max(1, min(lists, len(chosen)))

    def extra(self, size: np.ndarray) -> np.ndarray:
        """The component that makes vectors of a squared length as long as the longest."""
        return np.sqrt(np.maximum(self.longest - size.astype(np.float64), 0))

    def table(self, rows: np.ndarray) -> np.ndarray:
        """Distances of candidates to all pivots."""
        inner = products(rows, self.rows) + self.extra(squares(rows))[:, None] * self.own
        return np.sqrt(np.maximum(2 * self.longest - 2 * inner, 0)).astype(np.float32)

    def query_table(self, rows: np.ndarray) -> np.ndarray:
        """Distances of queries, whose own further component is zero."""
        return np.sqrt(np.maximum(squares(rows)[:, None] + self.longest - 2 * products(rows, self.rows).astype(np.float64), 0)).astype(np.float32)

    def reach(self, size: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """The highest score a candidate may have that is ``apart`` or more from a query of that squared length."""
        slack = SLACK * (np.sqrt(size) + self.longest**0.5) + 1e-9
        whole = size + self.longest
        return (whole - np.maximum(apart - slack, 0) ** 2) / 2 + 1e-9 * whole + 1e-6

    def thresholds(self, rows: np.ndarray) -> np.ndarray:
        """A score that k candidates reach at least, for each query; the lowest there is where the sample is smaller."""
        if len(self.sample) < self.k:
            return np.full(len(rows), np.iinfo(np.int64).min)
        scores = products(rows, self.sample)
        return np.partition(scores, len(self.sample) - self.k, axis=1)[:, len(self.sample) - self.k]


ROUTED = "list int, batch long, n long, radius double, own binary"
ASKED = "list int, batch long, n long, ask binary"


def _lists(pivots: Pivots, width: int):
    """Candidates to what each list gets of a batch: ids, nulls, row numbers, vectors and their distances to the pivots."""
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), BATCH):
                part = frame.iloc[a:a + BATCH]
                rows = matrix(part["vector"], width)
                table = pivots.table(rows)
                home = table[:, : pivots.lists].argmin(axis=1)
                ids, nulls = ids_and_nulls(part["vec_id"])
                number = part["row"].to_numpy(np.int64)
                out = []
                for k in np.unique(home):
                    own = home == k
                    out.append((int(k), int(number[0]), int(own.sum()), float(table[own, k].max()), pack(ids[own], nulls[own], number[own], rows[own], table[own])))
                yield pd.DataFrame(out, columns=["list", "batch", "n", "radius", "own"])

    return run


def _questions(pivots: Pivots, width: int, radius: dict[int, float]):
    """Queries to what they ask each list that may hold a score at their threshold: key, vector, distances to the pivots, threshold."""
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), BATCH):
                part = frame.iloc[a:a + BATCH]
                rows = matrix(part["vector"], width)
                table, least = pivots.query_table(rows), pivots.thresholds(rows)
                keys = np.array(part["key"].tolist(), "S32")
                size = squares(rows).astype(np.float64)
                out = []
                for k, r in radius.items():
                    some = pivots.reach(size, table[:, k] - r * (1 + 1e-6)) >= least
                    if some.any():
                        out.append((k, int(part["row"].iloc[0]), int(some.sum()), pack(keys[some], rows[some], table[some], least[some])))
                yield pd.DataFrame(out, columns=["list", "batch", "n", "ask"])

    return run


def _search(pivots: Pivots):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """One block's candidates for each query of a turn, in the order of their bounds."""
        ids, nulls, number, rows, table = unpack_all(x for x in frame["own"] if x)
        out = []
        for data in frame["ask"]:
            if not data:
                continue
            keys, queries, distances, least = unpack(data)
            size = squares(queries)
            for key, query, own, s, low in zip(keys, queries, distances, size, least):
                bound = np.abs(table - own).max(axis=1)
                reach = pivots.reach(float(s), bound)
                order = np.flatnonzero(reach >= low)
                order = order[np.argsort(bound[order], kind="stable")]
                best, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST
                while at < len(order) and reach[order[at]] >= low:
                    more = order[at:at + step]
                    here = products(query[None], rows[more])[0]
                    best, scores = np.concatenate([best, more]), np.concatenate([scores, here])
                    top = ranked(scores, nulls[best], ids[best], number[best])[: pivots.k]
                    best, scores = best[top], scores[top]
                    if len(best) == pivots.k:
                        low = max(low, scores[-1])
                    at, step = at + step, 2 * step
                keep = scores >= low
                out.append((key.decode(), best[keep], scores[keep]))
        at = np.concatenate([x for _, x, _ in out]) if out else np.zeros(0, np.int64)
        return pd.DataFrame({"key": pd.Series([k for k, x, _ in out for _ in x], dtype=object), "vec_id": pd.Series(ids[at], dtype="Int64").mask(nulls[at]), "row": number[at],
                             "score": np.concatenate([s for _, _, s in out]) if out else np.zeros(0, np.int64)})

    return run


def top_k(rows: DataFrame, asks: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows of highest inner product for each row for which ``asks`` is true.

    ``rows`` has vec_id (long) and vector (array of long, null: takes no part). A query's own row isn't among its finds; rows with the same
    vec_id are rows of their own. Ties come by vec_id, nulls last. Shorter vectors count as ending in zeros. Queries without any other row have
    no finds; equal vectors are searched once, and of them only the first ``k`` + 1 can be found. Other columns don't matter.
    """
    rows = stored(rows.filter(F.col("vector").isNotNull()).select("vec_id", "vector", F.coalesce(asks, F.lit(False)).alias("asks"))
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = F.aggregate("vector", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    facts = {"n": F.count(F.lit(1)), "width": F.max(F.size("vector")), "longest": F.max(size)}
    candidates, seen = stored_with(first_of_equals(rows.select("vec_id", "row", "vector"), ["vector"], k + 1), "candidates", **facts)
    kinds = "query_id long, rank int, vec_id long, score long"
    if not seen["n"]:
        return rows.sparkSession.createDataFrame([], kinds)
    width = seen["width"]
    sample = matrix([r["vector"] for r in sampled(candidates, ["vector", "row"], width)], width)
    pivots = Pivots(sample, seen["longest"], -(-seen["n"] // LIST_MEMBERS), k + 1)
    members = stored(candidates.mapInPandas(tidy(_lists(pivots, width)), ROUTED), "lists")
    radius = {r["list"]: r["radius"] for r in members.groupBy("list").agg(F.max("radius").alias("radius")).collect()}
    queries = stored(rows.filter("asks").select("vec_id", "row", "vector", digest("vector").alias("key")), "queries")
    asking = queries.groupBy("key").agg(F.first("vector").alias("vector"), F.min("row").alias("row"))
    asking = stored(asking.mapInPandas(tidy(_questions(pivots, width, radius)), ASKED), "asking")
    tasks = met(in_blocks(members, MEMBERS).select("list", "block", "own"), asking, ASKING)
    found = tasks.groupBy("list", "block", "turn").applyInPandas(tidy(_search(pivots)), FOUND)
    finds = attach(queries.select("key", F.col("vec_id").alias("query_id"), "row"), first_by_key(found, k + 1), ["key"], "finds")
    others = F.slice(F.filter("top", lambda x: x["row"] != F.col("row")), 1, k)
    return (finds.select("query_id", F.posexplode(others).alias("place", "find"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "find.vec_id", "find.score"))


def embedding_neighbours(vectors: DataFrame, k: int, every: int) -> DataFrame:
    """``top_k`` of the embeddings (vec_id, embedding) as whole numbers floor(256 x); rows whose vec_id ``every`` divides are queries."""
    return top_k(vectors.select("vec_id", whole("embedding").alias("vector")), F.col("vec_id") % every == 0, k)
