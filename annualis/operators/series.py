"""Features of per-entity series.

A series has at most one row per (entity, period) - ``quality.check_unique`` tests
that - so the window of an entity holds no more rows than there are periods. For
entities with any number of rows (measurements, logs) use ``long_series_features``
or ``long_calendar_features``, which never put a whole entity into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from annualis.functions.scalar import rounded, safe_div
from annualis.operators.ordered import ordered_rank, over_blocks, over_ranges
from annualis.session import attach


def growth_expr(v: Column, prev: Column, digits: int | None = 2) -> Column:
    """Change against the previous value in percent; NULL if there is none or it is 0."""
    return rounded(F.when(prev != 0, (v - prev) / prev * 100), digits)


def cagr_expr(v: Column, base: Column, periods: int, digits: int | None = 2) -> Column:
    """Compound growth per period in percent against ``base``; NULL unless ``base`` > 0."""
    return rounded(F.when(base > 0, (F.pow(v / base, F.lit(1.0 / periods)) - 1) * 100), digits)


def minmax_expr(v: Column, low: Column, high: Column, digits: int | None = 4) -> Column:
    """Position in [low, high]; a flat series gives 0."""
    span = high - low
    return rounded((v - low) / F.when(span == 0, F.lit(1.0)).otherwise(span), digits)


def versus_expr(v: Column, avg: Column, digits: int | None = 2) -> Column:
    """Distance from the mean in percent; NULL unless the mean is > 0."""
    return rounded(F.when(avg > 0, (v - avg) / avg * 100), digits)


def _ordered(key: str, ord: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(ord)


def growth(df: DataFrame, key="area", ord="year", v="value_tonnes", name="yoy_growth_pct", digits=2) -> DataFrame:
    prev = df.withColumn("_prev", F.lag(v, 1).over(_ordered(key, ord)))
    return prev.withColumn(name, growth_expr(F.col(v), F.col("_prev"), digits)).drop("_prev")


def moving_avg(df: DataFrame, key="area", ord="year", v="value_tonnes", n=5, name="ma5_tonnes", digits=2,
               mode="rows") -> DataFrame:
    """Mean of the last ``n`` rows (``mode="rows"``) or of the last ``n`` periods (``"calendar"``)."""
    w = _ordered(key, ord)
    frame = w.rowsBetween(1 - n, 0) if mode == "rows" else w.rangeBetween(1 - n, 0)
    return df.withColumn(name, rounded(F.avg(v).over(frame), digits))


def cagr(df: DataFrame, key="area", ord="year", v="value_tonnes", n=5, name="cagr_5y_pct", digits=2) -> DataFrame:
    base = df.withColumn("_base", F.lag(v, n).over(_ordered(key, ord)))
    return base.withColumn(name, cagr_expr(F.col(v), F.col("_base"), n, digits)).drop("_base")


def minmax(df: DataFrame, key="area", v="value_tonnes", name="value_normalized", digits=4, any_size=False) -> DataFrame:
    """Min-max position of each value within its entity over all periods.

    With ``any_size`` the bounds are aggregated and joined back, so that an entity
    of any number of rows stays spread over tasks.
    """
    if any_size:
        bounds = df.groupBy(key).agg(F.min(v).alias("_low"), F.max(v).alias("_high"))
        wide = attach(df, bounds, [key], "bounds", "left")
    else:
        w = Window.partitionBy(key)
        wide = df.withColumn("_low", F.min(v).over(w)).withColumn("_high", F.max(v).over(w))
    return wide.withColumn(name, minmax_expr(F.col(v), F.col("_low"), F.col("_high"), digits)).drop("_low", "_high")


def _with_period_mean(rows: DataFrame, df: DataFrame, period: str, v: str) -> DataFrame:
    means = df.groupBy(period).agg(F.avg(v).alias("_avg"))
    return attach(rows, means, [period], "period-means", "left")


def vs_period_avg(df: DataFrame, period="year", v="value_tonnes", name="pct_vs_global_avg", digits=2) -> DataFrame:
    """Distance of each value from the mean of its period over all entities.

    The means are aggregated with map-side combine and joined back, because a window
    by period would put all entities of a period into one task.
    """
    joined = _with_period_mean(df, df, period, v)
    return joined.withColumn(name, versus_expr(F.col(v), F.col("_avg"), digits)).drop("_avg")


def series_features(df: DataFrame, key="area", ord="year", v="value_tonnes", rounding: bool = True) -> DataFrame:
    """All five features of a series table, on one shuffle by entity.

    ``df`` should be a stored table: it is read twice, two columns the first time.
    Lags are taken once and shared by the features built on them.
    """
    def digits(n):
        return n if rounding else None

    w, whole = _ordered(key, ord), Window.partitionBy(key)
    value, order = F.col(v), [key, ord, v, "yoy_growth_pct", "ma5_tonnes", "cagr_5y_pct", "value_normalized"]
    rest = [c for c in df.columns if c not in (key, ord, v)]
    wide = df.withColumns({
        "_prev": F.lag(v, 1).over(w),
        "_base": F.lag(v, 5).over(w),
        "_mean": F.avg(v).over(w.rowsBetween(-4, 0)),
        "_low": F.min(v).over(whole),
        "_high": F.max(v).over(whole),
    })
    return _with_period_mean(wide, df, ord, v).withColumns({
        "yoy_growth_pct": growth_expr(value, F.col("_prev"), digits(2)),
        "ma5_tonnes": rounded(F.col("_mean"), digits(2)),
        "cagr_5y_pct": cagr_expr(value, F.col("_base"), 5, digits(2)),
        "value_normalized": minmax_expr(value, F.col("_low"), F.col("_high"), digits(4)),
        "pct_vs_global_avg": versus_expr(value, F.col("_avg"), digits(2)),
    }).select(*order, "pct_vs_global_avg", *rest)


def long_series_features(df: DataFrame, key: str, order: Sequence[str], v: str, rounding: bool = True,
                         block_rows: int = 100_000, partitions: int | None = None) -> DataFrame:
    """Growth, moving mean, compound growth and min-max for entities of any length.

    ``order`` ends in a unique column. Rows are ranked by a range shuffle and the
    windows run on blocks of ``block_rows`` rows, so a key that holds a third of all
    rows is worked on by as many tasks as its rows need.
    """
    def digits(n):
        return n if rounding else None

    ranked = ordered_rank(df, [key], order, "_rank", partitions)
    wide = over_blocks(ranked, [key], "_rank", 5, {
        "_prev": lambda w: F.lag(v, 1).over(w),
        "_base": lambda w: F.lag(v, 5).over(w),
        "_mean": lambda w: F.avg(v).over(w.rowsBetween(-4, 0)),
    }, block_rows)
    value = F.col(v)
    wide = wide.withColumns({
        "growth_pct": growth_expr(value, F.col("_prev"), digits(2)),
        "ma5": rounded(F.col("_mean"), digits(2)),
        "cagr_5_pct": cagr_expr(value, F.col("_base"), 5, digits(2)),
    }).drop("_prev", "_base", "_mean", "_rank")
    bounds = df.groupBy(key).agg(F.min(v).alias("_low"), F.max(v).alias("_high"))
    normalised = minmax_expr(value, F.col("_low"), F.col("_high"), digits(4))
    return attach(wide, bounds, [key], "bounds", "left").withColumn("normalized", normalised).drop("_low", "_high")


def densify(df: DataFrame, key="area", ord="year") -> DataFrame:
    """One row per entity and period between the entity's first and last, values NULL in gaps."""
    ends = df.groupBy(key).agg(F.min(ord).alias("_a"), F.max(ord).alias("_b"))
    spine = ends.select(key, F.explode(F.sequence("_a", "_b")).alias(ord))
    return spine.join(df, [key, ord], "left").select(*df.columns)


def calendar_features(df: DataFrame, key="area", ord="year", v="value_tonnes", rounding: bool = True) -> DataFrame:
    """Growth, moving mean and compound growth by calendar: a gap is a missing value, not the row before.

    Rows of the input only; growth needs the period before, compound growth the fifth before.
    """
    def digits(n):
        return n if rounding else None

    w = _ordered(key, ord)
    value = F.col(v)
    at = lambda k: F.max(v).over(w.rangeBetween(-k, -k))
    wide = df.withColumns({
        "_prev": at(1), "_base": at(5), "_mean": F.avg(v).over(w.rangeBetween(-4, 0)),
    })
    return wide.select(
        *df.columns,
        growth_expr(value, F.col("_prev"), digits(2)).alias("yoy_growth_pct"),
        rounded(F.col("_mean"), digits(2)).alias("ma5_tonnes"),
        cagr_expr(value, F.col("_base"), 5, digits(2)).alias("cagr_5y_pct"),
    )


def long_calendar_features(df: DataFrame, key="area", ord="year", v="value_tonnes", rounding: bool = True,
                           span: int = 10_000) -> DataFrame:
    """``calendar_features`` for entities of any length, and any number of rows per entity and period.

    Rows collapse to one per (entity, period) before the shuffle; windows run on blocks of ``span`` periods. The
    results are joined back, where an (entity, period) with very many rows is spread.
    """
    def digits(n):
        return n if rounding else None

    per = df.groupBy(key, ord).agg(F.max(v).alias("_v"), F.sum(v).alias("_s"), F.count(v).alias("_c"))
    at = lambda k: lambda w: F.max("_v").over(w.rangeBetween(-k, -k))
    recent = lambda c: lambda w: F.sum(c).over(w.rangeBetween(-4, 0))
    wide = over_ranges(per, [key], ord, 5, {"_prev": at(1), "_base": at(5), "_sum": recent("_s"), "_count": recent("_c")}, span)
    wide = wide.select(key, ord, "_prev", "_base", safe_div(F.col("_sum"), F.col("_count")).alias("_mean"))
    value = F.col(v)
    return attach(df, wide, [key, ord], "calendar", "left").select(
        *df.columns,
        growth_expr(value, F.col("_prev"), digits(2)).alias("yoy_growth_pct"),
        rounded(F.col("_mean"), digits(2)).alias("ma5_tonnes"),
        cagr_expr(value, F.col("_base"), 5, digits(2)).alias("cagr_5y_pct"),
    )


def entities(df: DataFrame, key="area") -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def first_entities(df: DataFrame, n: int, key="area") -> DataFrame:
    """Rows of the first ``n`` entities in list order; the broadcast side holds ``n`` rows."""
    return df.join(F.broadcast(entities(df, key).limit(n)), key, "left_semi")


def history(df: DataFrame, area=None, key="area", ord="year") -> DataFrame:
    """Series in order of entity and period; one entity only if ``area`` is given."""
    if area is None:
        return df.orderBy(key, ord)
    return df.filter(F.col(key) == area).drop(key).orderBy(ord)


def total_by(df: DataFrame, key: str, v: str, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(v).alias(name))


def top_entities(df: DataFrame, n: int = 10, key="area", v="value_tonnes") -> DataFrame:
    """Rows of the ``n`` entities with the largest total; ties go to the smaller key.

    The broadcast side holds ``n`` rows by construction.
    """
    best = total_by(df, key, v, "_total").orderBy(F.desc("_total"), key).limit(n).select(key)
    return df.join(F.broadcast(best), key, "left_semi")


def series_stats(df: DataFrame, key="area", ord="year", v="value_tonnes", yoy="yoy_growth_pct") -> DataFrame:
    """Per entity: total, peak and its first period, last value and its period, last growth that is not NULL."""
    growth_at = F.when(F.col(yoy).isNotNull(), F.col(ord))
    return df.groupBy(key).agg(
        F.sum(v).alias("total"),
        F.max(v).alias("peak"),
        F.max_by(ord, F.struct(v, -F.col(ord))).alias("peak_period"),
        F.max_by(v, ord).alias("last_value"),
        F.max(ord).alias("last_period"),
        F.max_by(yoy, growth_at).alias("last_growth"),
    )


def last_not_null(df: DataFrame, ord: str, v: str, by: Sequence[str] = ()) -> DataFrame:
    """The latest value that is not NULL, per group."""
    return df.groupBy(*by).agg(F.max_by(v, F.when(F.col(v).isNotNull(), F.col(ord))).alias("last_value"))


def future_spine(df: DataFrame, key="area", ord="year", horizon: int = 5) -> DataFrame:
    """The next ``horizon`` periods after each entity's own last one."""
    last = df.groupBy(key).agg(F.max(ord).alias("_last"))
    return last.select(key, F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + horizon)).alias(ord))
