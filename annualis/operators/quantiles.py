"""Exact quantiles, box-plot summaries and Q-Q points without a global sort in one task.

A small group's values are sorted in one task. Quantiles of large groups are found by narrowing: count values in equal bins of each group's range, keep the bins
that hold the wanted ranks, and bin those again until few rows are left. What is
shuffled are bin counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.functions.scalar import with_normal_quantile
from annualis.operators.ordered import ordered_rank
from annualis.session import attach, join_counted, join_same, stored_with


def _locate(cells: DataFrame, keys: Sequence[str], targets: DataFrame, order: str) -> DataFrame:
    """For each target rank the cell that holds it; the rank becomes relative to the cell."""
    earlier = Window.partitionBy(*keys, "_seg").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    hit = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    return join_same(placed, targets, [*keys, "_seg"]).filter(hit)


def _inside(rows: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """Rows that fall into a searched cell. Cells of a group are disjoint, two per quantile at most."""
    cells = targets.select(*keys, "_seg", "_lo", "_hi").distinct()
    within = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    if keys:
        return attach(rows, cells, list(keys), "cells").filter(within)
    return rows.join(F.broadcast(cells), within)


def _store_targets(targets: DataFrame) -> tuple[DataFrame, int]:
    """The targets, and the rows of the largest cell that holds more than one value."""
    largest = F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_size")))
    out, seen = stored_with(targets, "targets", largest=largest)
    return out, seen["largest"] or 0


LARGEST = 1.7976931348623157e308


def _between(low, high, at) -> Column:
    """Linear interpolation between the values at the ranks around ``at``; equal neighbours, also infinite ones, as they are."""
    upper = at - F.floor(at)
    return F.when(low == high, low).otherwise(low * (F.lit(1.0) - upper) + high * upper)


def exact_quantiles(df: DataFrame, keys: Sequence[str], v: str, qs: Sequence[float], cell_rows: int = 1_000_000,
                    bins: int = 4096) -> DataFrame:
    """Quantiles with linear interpolation, per group: ``(keys, q, value, n)``; NULL and NaN do not count.

    Groups up to ``cell_rows`` rows are sorted, each in one task; larger ones are narrowed. Both find the two
    values around a quantile and interpolate alike, so ``cell_rows`` does not change a result. A NULL key is a group.
    """
    keys = list(keys)
    rows = df.select(*keys, (F.col(v).cast("double") + F.lit(0.0)).alias("_v")).dropna(subset=["_v"])
    sizes = rows.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("n")
    )
    large, seen = stored_with(sizes.filter(F.col("n") > cell_rows), "large-groups", n=F.count(F.lit(1)))
    if not seen["n"]:
        return _of_small_groups(rows, keys, qs)
    narrowed = _of_large_groups(rows, keys, large, qs, cell_rows, bins)
    if not keys:
        return narrowed
    others = join_counted(rows, large.select(*keys), seen["n"], keys, "left_anti")
    return _of_small_groups(others, keys, qs).unionByName(narrowed)


def _of_small_groups(rows: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    probs = F.array(*[F.lit(float(q)) for q in qs])
    sorted_values = F.sort_array(F.collect_list("_v")).alias("_s")
    wide = rows.groupBy(*keys).agg(sorted_values, F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0)
    at = F.col("q") * (F.col("n") - 1)
    pick = lambda place: F.element_at("_s", (place + 1).cast("int"))
    long = wide.withColumn("q", F.explode(probs))
    return long.select(*keys, "q", _between(pick(F.floor(at)), pick(F.ceil(at)), at).alias("value"), "n")


def _of_large_groups(rows: DataFrame, keys: Sequence[str], large: DataFrame, qs: Sequence[float], cell_rows: int,
                     bins: int) -> DataFrame:
    """As long as a searched cell (at first a whole group) has more than ``cell_rows`` rows, cut it.

    A cell is cut into ``bins`` equal bins of its own finite range, and one for either infinity, so its two ends
    always part. A round reads one column and shuffles at most ``bins`` counts per cell and task. At the end
    the distinct values inside the cells are counted and picked by rank.
    """
    at = F.col("q") * (F.col("n") - 1)
    wanted = large.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    wanted = wanted.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))))
    targets, largest = _store_targets(
        wanted.withColumns({"_goal": F.col("_rank"), "_seg": F.lit("0"), "_size": F.col("n")}))
    columns = [*keys, "_seg", "q", "n", "_goal", "_rank"]
    low, high = F.greatest(F.col("_lo"), F.lit(-LARGEST)) / 2, F.least(F.col("_hi"), F.lit(LARGEST)) / 2  # halves, as the range may overflow
    share = (F.col("_v") / 2 - low) / F.when(high > low, high - low)
    slot = (F.when(F.col("_v") < -LARGEST, F.lit(-1)).when(F.col("_v") > LARGEST, F.lit(bins))
            .otherwise(F.coalesce(F.least(F.floor(share * F.lit(float(bins))), F.lit(bins - 1)), F.lit(0))))
    while largest > cell_rows:
        inside = _inside(rows, keys, targets)
        counts = inside.groupBy(*keys, "_seg", slot.cast("bigint").alias("_bin")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo2"), F.max("_v").alias("_hi2"))
        found = _locate(counts, keys, targets.select(*columns), "_bin")
        targets, largest = _store_targets(found.select(
            *keys, "q", "n", "_goal", (F.col("_rank") - F.col("_before")).alias("_rank"),
            F.concat_ws(".", "_seg", F.col("_bin").cast("string")).alias("_seg"),
            F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"), F.col("_n").alias("_size")))
    counts = _inside(rows, keys, targets).groupBy(*keys, "_seg", "_v").agg(F.count(F.lit(1)).alias("_n"))
    found = _locate(counts, keys, targets.select(*columns), "_v")
    ends = found.groupBy(*keys, "q", "n").agg(
        F.min_by("_v", "_goal").alias("_a"), F.max_by("_v", "_goal").alias("_b"))
    return ends.select(*keys, "q", _between(F.col("_a"), F.col("_b"), at).alias("value"), "n")


def approx_quantiles(df: DataFrame, keys: Sequence[str], v: str, qs: Sequence[float],
                     accuracy: int = 10_000) -> DataFrame:
    """Quantile sketch in one pass: rank error at most n/``accuracy``; same columns as ``exact_quantiles``."""
    probs = F.array(*[F.lit(float(q)) for q in qs])
    x = F.nanvl(F.col(v).cast("double"), F.lit(None).cast("double"))
    wide = df.groupBy(*keys).agg(
        F.percentile_approx(x, probs, F.lit(accuracy)).alias("_v"), F.count(x).alias("n")).filter(F.col("n") > 0)
    rows = F.arrays_zip(probs.alias("q"), F.col("_v").alias("value"))
    return wide.select(*keys, F.inline(rows).alias("q", "value"), "n")


def box_stats(df: DataFrame, keys: Sequence[str], v: str, exact: bool = True) -> DataFrame:
    """Quartiles, whiskers at the last point within 1.5 IQR, and outlier counts per group; NULL and NaN do not count."""
    keys = list(keys)
    find = exact_quantiles if exact else approx_quantiles
    long = find(df, keys, v, [0.25, 0.5, 0.75])
    at = lambda q: F.max(F.when(F.col("q") == q, F.col("value")))
    quartiles = long.groupBy(*keys).agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    low = F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))
    x = F.col(v)
    known = df.filter(x.isNotNull() & ~F.isnan(x.cast("double")))
    return attach(known, quartiles, keys, "quartiles").groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(x >= low, x)).alias("whisker_low"),
        F.max(F.when(x <= high, x)).alias("whisker_high"),
        F.count_if((x < low) | (x > high)).alias("outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def outliers(df: DataFrame, keys: Sequence[str], v: str, boxes: DataFrame) -> DataFrame:
    """The rows outside the whiskers of ``boxes``; NULL and NaN are not outside."""
    ends = boxes.select(*keys, "whisker_low", "whisker_high")
    x = F.col(v)
    outside = ~F.isnan(x.cast("double")) & ((x < F.col("whisker_low")) | (x > F.col("whisker_high")))
    return attach(df, ends, list(keys), "boxes").filter(outside).select(*df.columns)


def qq_points(df: DataFrame, c: str, tie: str, partitions: int | None = None) -> DataFrame:
    """Every value with its rank and the normal quantile of Filliben's median position: ``(i, theoretical, ordered)``."""
    values = df.filter(F.col(c).isNotNull())
    ranked = ordered_rank(values.select(c, tie), [], [c, tie], "i", partitions)
    n = values.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    position = (
        F.when(F.col("i") == n, top).when(F.col("i") == 1, F.lit(1.0) - top)
        .otherwise((F.col("i") - F.lit(0.3175)) / (n + F.lit(0.365)))
    )
    return with_normal_quantile(ranked, position, "theoretical").select("i", "theoretical", F.col(c).alias("ordered"))


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through Q-Q points and their correlation."""
    return points.agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
    )


def qq_grid(df: DataFrame, c: str, points: int = 199, accuracy: int = 10_000) -> DataFrame:
    """Q-Q data on a fixed grid of probabilities from a quantile sketch, in one pass."""
    probs = [(i + 1) / (points + 1) for i in range(points)]
    grid = approx_quantiles(df, [], c, probs, accuracy)
    return with_normal_quantile(grid, F.col("q"), "theoretical").select("theoretical", F.col("value").alias("ordered"))
