"""Whole-number vectors with exact inner products, and their rows as binary blocks that tasks compare."""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LARGEST = float(2**61)  # squared length from which on a vector's scores may not fit a long
SAMPLE_ROWS, SAMPLE_NUMBERS = 4_096, 1 << 20  # bounds of what is collected to choose pivots and first thresholds
EXACT = float(2**52)


def whole(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null for vectors that are null, hold null or numbers that aren't finite, or are too long to score."""
    scaled = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    sound = F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.aggregate(column, F.lit(0.0), lambda a, x: a + F.pow(F.lit(float(scale)) * x.cast("double"), 2))
    return F.when(sound & (size < LARGEST), scaled)


def digest(vector: str, *more: str) -> Column:
    """128 bits that name a vector, with other columns."""
    return F.md5(F.concat_ws("|", F.concat_ws(",", F.transform(vector, lambda x: x.cast("string"))), *[F.col(c).cast("string") for c in more]))


def first_of_equals(rows: DataFrame, same: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by vec_id (nulls last) and row number of each set of equal rows; the others can't be among the first ``n`` of any search."""
    order = Window.partitionBy(*same).orderBy(F.col("vec_id").asc_nulls_last(), "row")
    return rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n).drop("nth")


def matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for k, v in enumerate(column):
        out[k, : len(v)] = v
    return out


def squares(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``, in doubles while these hold every partial sum."""
    longest = [float(squares(x).max(initial=0)) ** 0.5 for x in (a, b)]
    if longest[0] * longest[1] < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one, whole numbers as narrow as they fit."""
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        if a.dtype == np.int64:
            low, high = int(a.min(initial=0)), int(a.max(initial=0))
            a = a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))
        data = np.ascontiguousarray(a).tobytes()
        out += [a.dtype.str.encode().ljust(8), np.array([a.ndim, *a.shape, len(data)], np.int64).tobytes(), data]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 8
    for _ in range(int(np.frombuffer(raw, np.int64, 1)[0])):
        kind = np.dtype(raw[at:at + 8].strip().decode())
        ndim = int(np.frombuffer(raw, np.int64, 1, at + 8)[0])
        *shape, size = np.frombuffer(raw, np.int64, ndim + 1, at + 16).tolist()
        at += 24 + 8 * ndim
        a = np.frombuffer(raw, kind, size // kind.itemsize, at).reshape(shape)
        out.append(a.astype(np.int64) if a.dtype.kind == "i" else a)
        at += size
    return out


def unpack_all(blobs) -> list[np.ndarray]:
    """The arrays of several blobs, each end to end."""
    return [np.concatenate(x) for x in zip(*map(unpack, blobs))]


def ids_and_nulls(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    ids = column.astype("Int64")
    return ids.fillna(0).to_numpy(np.int64), ids.isna().to_numpy()


def ranked(scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places by falling score; ties by id, nulls last, then by row."""
    return np.lexsort((rows, ids, nulls, -scores))


def sampled(rows: DataFrame, columns: list[str], width: int) -> list:
    """A bounded number of rows, told by the hash of their vectors."""
    n = max(64, min(SAMPLE_ROWS, SAMPLE_NUMBERS // max(1, width)))
    return rows.select(*columns).orderBy(F.xxhash64("vector"), "row").limit(n).collect()


def farthest_first(rows: np.ndarray, extra: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chosen, gaps, far): up to ``n`` rows, each the farthest from those before, how far it was, and the distances of all rows from each.

    Distances are between rows with ``extra`` as one more component.
    """
    points = np.concatenate([rows.astype(np.float64), extra[:, None]], axis=1)
    own = squares(points)
    chosen, gaps, far = [], [], []
    near, at, gap = np.full(len(points), np.inf), 0, np.inf
    while len(chosen) < min(n, len(points)) and gap > 0:
        chosen.append(at)
        gaps.append(gap)
        far.append(np.sqrt(np.maximum(own + own[at] - 2 * (points @ points[at]), 0)))
        near = np.minimum(near, far[-1])
        near[at] = 0
        at = int(near.argmax())
        gap = near[at]
    return np.array(chosen, np.int64), np.array(gaps), np.array(far)


def in_blocks(members: DataFrame, size: int) -> DataFrame:
    """Rows (list, batch, n, own) with ``block``: the lists cut into blocks of about ``size`` members. There must be few lists."""
    blocks = members.groupBy("list").agg(F.ceil(F.sum("n") / size).cast("long").alias("blocks"))
    return members.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("list", "batch"), "blocks")).drop("blocks")


def met(blocks: DataFrame, asking: DataFrame, size: int) -> DataFrame:
    """Rows (list, block, turn, own, ask) of tasks in which every block of a list meets each of its queries once.

    ``blocks`` has rows (list, block, own), ``asking`` rows (list, batch, n, ask), cut into turns of about ``size`` queries.
    """
    turns = asking.groupBy("list").agg(F.ceil(F.sum("n") / size).cast("long").alias("turns"))
    counts = blocks.groupBy("list").agg((F.max("block") + 1).alias("blocks")).join(F.broadcast(turns), "list")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    blank = F.lit(None).cast("binary")
    owned = blocks.join(F.broadcast(counts), "list").select("list", "block", upto("turns").alias("turn"), "own", blank.alias("ask"))
    asked = asking.join(F.broadcast(counts), "list").select(
        "list", upto("blocks").alias("block"), F.pmod(F.xxhash64("list", "batch"), "turns").alias("turn"), blank.alias("own"), "ask")
    return owned.unionAll(asked)


FOUND = "key string, vec_id long, row long, score long"


def first_by_key(found: DataFrame, n: int, *more: str) -> DataFrame:
    """The ``n`` first finds of each key by falling score, ties by vec_id (nulls last) and row, as one array ``top`` a key."""
    order = Window.partitionBy("key", *more).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    best = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)
    return best.groupBy("key", *more).agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "row", "score"))).alias("top"))
