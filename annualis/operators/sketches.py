"""Quantile sketches stored per period, merged for any range of periods without reading the rows again.

A sketch holds a few thousand values at most, whatever the rows behind it. Its rank error is about
``2.3 / k ** 0.9`` of the rows (99 of 100 sketches are within), and merging keeps that bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis.functions.scalar import with_normal_quantile
from annualis.sources.sinks import write_partitioned

SIZE = 800  # the sketch's k


def rank_error(k: int = SIZE) -> float:
    """Share of the rows by which the rank of a quantile may be off."""
    return 2.296 / k**0.9021


def sketch(df: DataFrame, keys: Sequence[str], period: str, v: str, k: int = SIZE) -> DataFrame:
    """``(keys, period, sketch, n)``: a sketch of ``v`` per group and period; NULL and NaN do not count.

    Sketches combine before the shuffle, so a hot group sends one sketch a task. Groups without a value have no row.
    """
    x = F.nanvl(F.col(v).cast("double"), F.lit(None).cast("double"))
    per = df.groupBy(*keys, period).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count(x).alias("n"))
    return per.filter(F.col("n") > 0)


def store_sketches(df: DataFrame, path: str, keys: Sequence[str], period: str, v: str, k: int = SIZE) -> None:
    """Write the sketches in one folder per period; periods that ``df`` has no rows of keep theirs."""
    write_partitioned(sketch(df, keys, period, v, k), path, period, keys, only_present=True)


def merged(spark: SparkSession, path: str, keys: Sequence[str], period: str, low=None, high=None) -> DataFrame:
    """``(keys, sketch, n)`` over the stored periods from ``low`` to ``high``, both included; other folders are not read."""
    stored = spark.read.parquet(path)
    if low is not None:
        stored = stored.filter(F.col(period) >= low)
    if high is not None:
        stored = stored.filter(F.col(period) <= high)
    return stored.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n")).filter(F.col("n") > 0)


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """``(keys, q, value, n)`` as ``exact_quantiles`` gives them, to the sketches' rank error; values are those of rows."""
    probs = F.array(*[F.lit(float(q)) for q in qs])
    pairs = F.arrays_zip(probs.alias("q"), F.kll_sketch_get_quantile_double("sketch", probs).alias("value"))
    return sketches.select(*keys, F.inline(pairs).alias("q", "value"), "n")


def sketch_boxes(sketches: DataFrame, keys: Sequence[str], grid: int = 1000) -> DataFrame:
    """Quartiles, fences at 1.5 IQR and the rows estimated outside of them, per group, from sketches alone.

    Outliers are the share of ``grid`` evenly spaced quantiles outside the fences, in rows.
    """
    at = lambda q: F.kll_sketch_get_quantile_double("sketch", F.lit(q))
    steps = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit((i + 0.5) / grid) for i in range(grid)]))
    boxes = sketches.select(*keys, "n", at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"), steps.alias("_steps"))
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    boxes = boxes.withColumns({"fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach})
    outside = F.size(F.filter("_steps", lambda x: (x < F.col("fence_low")) | (x > F.col("fence_high"))))
    return boxes.withColumn("outliers", F.round(outside * F.col("n") / F.lit(grid)).cast("bigint")).drop("_steps")


def sketch_qq(sketches: DataFrame, points: int = 199) -> DataFrame:
    """Q-Q data on a fixed grid of probabilities, of one merged sketch: ``(theoretical, ordered)``."""
    grid = sketch_quantiles(sketches, [], [(i + 1) / (points + 1) for i in range(points)])
    return with_normal_quantile(grid, F.col("q"), "theoretical").select("theoretical", F.col("value").alias("ordered"))
