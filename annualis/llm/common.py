"""Helpers that several operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import inspect
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from annualis.session import stored

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LINK_ROUNDS = 200  # far above the logarithm of any graph's size; reaching it raises


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_once(df: DataFrame, label: str = "step") -> DataFrame:
    """``stored`` for a plan that no one runs again: its shuffle files are removed when the table is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP)
    conf.set(CLEAN_UP, "true")
    try:
        return stored(df, label)
    finally:
        conf.set(CLEAN_UP, before)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the one column of ``values``; nulls stay."""
    name = fresh(df, "gone")
    return df.join(values.toDF(name), F.col(column) == F.col(name), "left_anti")


def utf8(values: Iterable) -> list[bytes]:
    """Texts as UTF-8; null counts as empty, a lone surrogate keeps its three bytes."""
    return [x.encode("utf-8", "surrogatepass") if isinstance(x, str) else b"" for x in values]


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most ``most`` in sum, or of one item."""
    begin, total = 0, 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def forget_half(memory: dict) -> None:
    """Drop the entries that came first."""
    for key in list(islice(memory, len(memory) // 2)):
        del memory[key]


def give_back() -> None:
    """Return freed memory to the system at the end of a task; the worker process goes on to other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """``run`` (a function of batches or of a group) that gives memory back when it is done."""
    if inspect.isgeneratorfunction(run):
        @functools.wraps(run)
        def stream(batches):
            yield from run(batches)
            give_back()

        return stream

    @functools.wraps(run)
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        out = run(frame)
        give_back()
        return out

    return one


def merge_labels(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the classes of ``left[k]`` and ``right[k]``; a label is the smallest index of its class."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def spread_work(routed: DataFrame, members: int, asking: int) -> DataFrame:
    """Rows (list, block, turn, own, ask) of bounded comparing tasks, to be grouped by the first three.

    ``routed`` has rows (list, batch, members, asking, own, ask): what a batch of rows puts into a list and
    what it asks the list for. A list is cut into blocks of about ``members`` and turns of about ``asking``;
    each block meets each turn once. There must be few lists.
    """
    sizes = routed.groupBy("list").agg(
        F.ceil(F.sum("members") / members).alias("blocks"), F.ceil(F.sum("asking") / asking).alias("turns"))
    split = routed.join(F.broadcast(sizes), "list").filter("blocks > 0")
    blank, spread = F.lit(None).cast("binary"), F.xxhash64("list", "batch")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    owned = split.filter("members > 0").select("list", F.pmod(spread, "blocks").alias("block"), upto("turns").alias("turn"), "own", blank.alias("ask"))
    asked = split.select("list", upto("blocks").alias("block"), F.pmod(spread, "turns").alias("turn"), blank.alias("own"), "ask")
    return owned.unionAll(asked)


SUM_GROUPS = 64


def array_row(array: np.ndarray) -> pd.DataFrame:
    """One row (part, data) for ``sum_arrays`` from a task."""
    from pyspark import TaskContext

    data = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array, np.float64).tobytes())
    context = TaskContext.get()
    return pd.DataFrame({"part": [context.partitionId() if context else 0], "data": [data]})


def _add_up(frame: pd.DataFrame) -> pd.DataFrame:
    return array_row(sum(np.frombuffer(zstandard.ZstdDecompressor().decompress(d)) for d in frame["data"]))


def sum_arrays(arrays: DataFrame) -> np.ndarray | None:
    """Sum of equally long arrays of doubles, of rows made by ``array_row``; null without rows.

    They are added in groups before the last one, so no task gets the arrays of all others.
    """
    for groups in (SUM_GROUPS, 1):
        arrays = arrays.groupBy(F.pmod("part", F.lit(groups))).applyInPandas(_add_up, "part int, data binary")
    row = arrays.first()
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"])) if row else None


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of the label.
    Labels are tables in the shared folder; no node's neighbours meet in one task, as the minimum
    is combined before the shuffle and the joins may be split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("component")), "labels")
    for _ in range(LINK_ROUNDS):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low")))
        hooked = labels.join(near, "node").select("node", F.least("component", "low").alias("up"), F.col("component").alias("old"))
        roots = labels.join(near, "node").select(F.col("node").alias("up"), F.least("component", "low").alias("top"))
        moved = hooked.join(roots, "up").select("node", F.least("up", "top").alias("component"), "old")
        seen = Observation(f"moved-{uuid.uuid4().hex}")
        moved = moved.observe(seen, F.sum((F.col("component") != F.col("old")).cast("long")).alias("n"))
        labels = stored(moved.drop("old"), "labels")
        if not seen.get["n"]:
            return labels
    raise RuntimeError("connected components did not settle")
