"""Descriptive statistics, error metrics, histograms and fits.

All are aggregations with map-side combine, so no group is ever held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.functions.scalar import normal_pdf, safe_div
from annualis.session import attach


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), c)


def mean_by(df: DataFrame, key: str, v: str, name: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(v).alias(name)).orderBy(name, key)


def mean_std_by(df: DataFrame, key: str, v: str) -> DataFrame:
    """Mean and sample deviation per class, largest mean first."""
    return df.groupBy(key).agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")).orderBy(F.desc("mean"), key)


def top_mean(df: DataFrame, key: str, v: str, n: int = 8) -> DataFrame:
    return df.groupBy(key).agg(F.avg(v).alias("mean")).orderBy(F.desc("mean"), key).limit(n)


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence[str], v: str) -> DataFrame:
    """Means by ``row`` with one column per class; NULL where there are no rows."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(v))


def residuals(df: DataFrame, y: str, yhat: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(y) - F.col(yhat))


def residual_bias(df: DataFrame, by: Sequence[str], residual: str = "residual") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(residual).alias("bias"))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def total_or_zero(df: DataFrame, v: str, name: str = "total") -> DataFrame:
    return df.agg(F.coalesce(F.sum(v), F.lit(0)).alias(name))


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R2, bias and population deviation of the residual, with n; overall or per group.

    Rows without target or prediction count for nothing. R2 is NULL where the target is constant.
    """
    target, r = F.col(y), F.col(y) - F.col(yhat)
    n = F.count(r)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        (1 - safe_div(F.sum(r * r), F.var_pop(F.when(r.isNotNull(), target)) * n)).alias("r2"),
        F.avg(r).alias("bias"),
        F.stddev_pop(r).alias("sigma"),
        n.alias("n"),
    )


def mape_expr(y: str, yhat: str) -> Column:
    """Mean absolute error in percent over rows whose actual is not 0; NULL if there is none."""
    actual = F.col(y)
    return F.avg(F.when(actual != 0, F.abs((actual - F.col(yhat)) / actual))) * 100


def mape(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    value = mape_expr(y, yhat)
    return df.groupBy(*by).agg((value if digits is None else F.round(value, digits)).alias("mape"))


def mean_mape(per_entity: DataFrame, digits: int | None = 2) -> DataFrame:
    """Mean of the per-entity scores; entities without a score do not count."""
    value = F.avg("mape")
    return per_entity.agg((value if digits is None else F.round(value, digits)).alias("avg_mape"))


def fold_summary(folds: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """Mean and spread over folds; ``ddof`` 1 for the sample, 0 for the population deviation."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    return folds.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), spread(c).alias(f"{c}_std"))])


def unpivot_row(df: DataFrame, keys: Sequence[str], values: Sequence[str], value_name: str,
                label: str = "column") -> DataFrame:
    """Wide aggregate to long rows ``(keys, label, value)``."""
    return df.unpivot(list(keys), list(values), label, value_name)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, strict lower triangle, as ``(a, b, r)``.

    One aggregation finds means and spreads, the next one sums products of
    standardised columns, a single sum per pair. Pairs with a column that has NULLs are
    correlated over the rows where both are known. Reads ``df`` twice; the means (one
    row) pass through the driver.
    """
    numbered = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = [f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}, count(x{i}) AS n{i}" for i in range(len(columns))]
    first = numbered.selectExpr("count(1) AS n", *", ".join(parts).split(", ")).first()
    whole = {i for i in range(len(columns)) if first[f"n{i}"] == first["n"]}
    varied = {i for i in range(len(columns)) if first[f"s{i}"]}
    z = [(F.col(f"x{i}") - F.lit(first[f"m{i}"])) / F.lit(first[f"s{i}"]) if i in varied else F.lit(None).cast("double")
         for i in range(len(columns))]

    def r(i: int, j: int) -> str:
        if {i, j} <= whole:
            return f"sum(z{i} * z{j}) / {first['n']}D"
        return f"corr(z{i}, z{j})"

    pairs = list(combinations(range(len(columns)), 2))
    standard = numbered.select(*[e.alias(f"z{i}") for i, e in enumerate(z)])
    wide = standard.selectExpr(*[f"{r(i, j)} AS r{i}_{j}" for i, j in pairs])
    rows = ", ".join(f"struct('{columns[j]}' AS a, '{columns[i]}' AS b, r{i}_{j} AS r)" for i, j in pairs)
    return wide.selectExpr(f"inline(array({rows}))")


def describe_vs_target(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """Per column: min, max, mean, sample deviation and correlation with the target (NULL for the target)."""
    def stats(c: str) -> list[Column]:
        r = F.lit(None).cast("double") if c == y else F.corr(c, y)
        x = F.col(c).cast("double")
        return [F.min(x), F.max(x), F.avg(x), F.stddev_samp(x), r]

    names = ["min", "max", "mean", "std", "corr"]
    wide = df.agg(*[e.alias(f"{n}{i}") for i, c in enumerate(columns) for n, e in zip(names, stats(c))])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(columns)
    ])
    return wide.select(F.inline(rows))


def histogram(df: DataFrame, c: str, bins: int = 40) -> DataFrame:
    """Equal bins between min and max, the last one closed: ``(bin, left, right, n, density)``.

    Empty bins are listed; a constant column gets a range of one around it. The range
    enters as a scalar subquery, not as a join.
    """
    values = df.filter(F.col(c).isNotNull())
    flat = F.when(F.min(c) == F.max(c), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = F.struct((F.min(c) - flat).alias("lo"), (F.max(c) + flat).alias("hi"), F.count(F.lit(1)).alias("n"))
    ends = values.agg(ends.alias("e")).scalar()
    span = ends["hi"] - ends["lo"]
    slot = F.floor(safe_div(F.col(c) - ends["lo"], span, F.lit(0.0)) * F.lit(float(bins)))
    counts = values.select(F.least(slot, F.lit(bins - 1)).cast("bigint").alias("bin"), F.lit(1).alias("n"))
    empty = df.sparkSession.range(bins).select(F.col("id").alias("bin"), F.lit(0).alias("n"))
    width = span / F.lit(float(bins))
    binned = counts.unionByName(empty).groupBy("bin").agg(F.sum("n").cast("bigint").alias("n"))
    return binned.select(
        "bin",
        (ends["lo"] + F.col("bin") * width).alias("left"),
        (ends["lo"] + (F.col("bin") + 1) * width).alias("right"),
        "n",
        safe_div(F.col("n").cast("double"), ends["n"] * width).alias("density"),
    )


def normal_curve(df: DataFrame, c: str, points: int = 200, reach: float = 4.0) -> DataFrame:
    """Normal density with the column's mean and population deviation, on mean +/- ``reach`` deviations."""
    fit = df.agg(F.avg(c).alias("mu"), F.stddev_pop(c).alias("sigma"))
    step = F.lit(2.0 * reach / (points - 1))
    grid = fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x", F.col("mu") + F.col("sigma") * (F.col("i") * step - F.lit(reach)))
    return grid.select(F.col("i").cast("bigint").alias("i"), "x", normal_pdf("x", "mu", "sigma").alias("density"))


def range_scale(df: DataFrame, keys: Sequence[str], columns: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Each column scaled to its class range, ``(x - min) / (max - min + eps)``, as ``<column>_scaled``."""
    ends = [e for c in columns for e in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))]
    wide = attach(df, df.groupBy(*keys).agg(*ends), list(keys), "ranges", "left")
    scaled = [
        ((F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}") + F.lit(eps))).alias(f"{c}_scaled")
        for c in columns
    ]
    return wide.select(*df.columns, *scaled)


def quad_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares ``y ~ c2 z^2 + c1 z + c0`` with ``z = (x - center) / scale``, per group or overall.

    Centring first keeps the sums of fourth powers well conditioned; the 3x3 system
    is solved in closed form. Needs three distinct x, else the coefficients are NULL; how many rows have them doesn't matter.
    Output: group, center, scale, c0, c1, c2, x_min, x_max, n.
    """
    pairs = df.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna(
        subset=["_x", "_y"])
    place = [F.avg("_x").alias("center"), F.stddev_pop("_x").alias("scale"),
             F.min("_x").alias("x_min"), F.max("_x").alias("x_max")]
    if by:
        centred = attach(pairs, pairs.groupBy(*by).agg(*place), list(by), "centers")
    else:
        where = pairs.agg(F.struct(*place).alias("p")).scalar()
        centred = pairs.select("_x", "_y", *[where[n].alias(n) for n in ("center", "scale", "x_min", "x_max")])
    z = safe_div(F.col("_x") - F.col("center"), F.col("scale"), F.lit(0.0))
    rows = centred.select(*by, "center", "scale", "x_min", "x_max", z.alias("z"), "_x", "_y")
    z, v = F.col("z"), F.col("_y")
    sums = rows.groupBy(*by).agg(
        *[F.first(c).alias(c) for c in ("center", "scale", "x_min", "x_max")],
        F.count(F.lit(1)).alias("n"),
        F.sum(z).alias("s1"), F.sum(z * z).alias("s2"), F.sum(z * z * z).alias("s3"), F.sum(z * z * z * z).alias("s4"),
        F.count_if((F.col("_x") > F.col("x_min")) & (F.col("_x") < F.col("x_max"))).alias("inner"),
        F.sum(v).alias("t0"), F.sum(z * v).alias("t1"), F.sum(z * z * v).alias("t2"),
    )
    n, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("n", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    whole = det(n, s1, s2, s1, s2, s3, s2, s3, s4)
    usable = (F.col("inner") > 0) & (whole > 0)
    solve = lambda top: F.when(usable, top / whole)
    return sums.select(
        *by, "center", "scale",
        solve(det(t0, s1, s2, t1, s2, s3, t2, s3, s4)).alias("c0"),
        solve(det(n, t0, s2, s1, t1, s3, s2, t2, s4)).alias("c1"),
        solve(det(n, s1, t0, s1, s2, t1, s2, s3, t2)).alias("c2"),
        "x_min", "x_max", "n",
    )


def quad_eval(fit: DataFrame, by: Sequence[str] = (), points: int = 100) -> DataFrame:
    """The fitted curve on ``points`` equal steps of the x range: ``(group, i, x, y)``."""
    grid = fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    share = F.col("i") / F.lit(float(points - 1))
    grid = grid.withColumn("x", F.col("x_min") + (F.col("x_max") - F.col("x_min")) * share)
    z = safe_div(F.col("x") - F.col("center"), F.col("scale"), F.lit(0.0))
    value = F.col("c0") + z * (F.col("c1") + z * F.col("c2"))
    return grid.select(*by, F.col("i").cast("bigint").alias("i"), "x", value.alias("y"))


def relative_to_max(df: DataFrame, v: str, by: Sequence[str] = ()) -> DataFrame:
    """``v`` as percent of the largest, per group; for aggregated tables (a few rows per group)."""
    return df.withColumn("pct_of_max", safe_div(F.col(v) * 100, F.max(v).over(Window.partitionBy(*by))))
