"""Contribution of each input to a prediction, from linear models.

For a linear model with independent inputs the Shapley value of input j is
``b_j * (x_j - mean(x_j))``. Slopes and means are one row of numbers and enter as a
scalar subquery.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.functions.scalar import map_lookup
from annualis.operators.stats import quad_fit, relative_to_max
from annualis.schemas import FEATURE_LABELS


def univariate_slopes(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """One row: slope of ``y`` on each column alone, and each column's mean, in one pass."""
    return df.agg(
        *[F.coalesce(F.regr_slope(y, c), F.lit(0.0)).alias(f"b_{c}") for c in columns],
        *[F.avg(c).alias(f"m_{c}") for c in columns],
    )


def _contributions(columns: Sequence[str], coefficients: DataFrame | Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    if isinstance(coefficients, DataFrame):
        row = coefficients.select(F.struct("*").alias("c")).scalar()
        return {c: row[f"b_{c}"] * (F.col(c) - row[f"m_{c}"]) for c in columns}
    return {c: F.lit(float(coefficients[c][0])) * (F.col(c) - F.lit(float(coefficients[c][1]))) for c in columns}


def linear_attributions(df: DataFrame, keys: Sequence[str], columns: Sequence[str], coefficients) -> DataFrame:
    """Long table ``(keys, feature, contribution)``; ``coefficients`` from ``univariate_slopes`` or {name: (slope, mean)}."""
    wide = df.select(*keys, *[e.alias(c) for c, e in _contributions(columns, coefficients).items()])
    return wide.unpivot(list(keys), list(columns), "feature", "contribution")


def mean_abs_attributions(df: DataFrame, columns: Sequence[str], coefficients, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute contribution per feature, overall or per class.

    Aggregates one wide row per class and unpivots afterwards, so rows are not multiplied.
    """
    parts = _contributions(columns, coefficients)
    wide = df.select(*by, *[F.abs(e).alias(c) for c, e in parts.items()])
    means = wide.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])
    return means.unpivot(list(by), list(columns), "feature", "mean_abs")


def top_features(table: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest features, overall or per class; a class has one row per feature here."""
    w = Window.partitionBy(*by).orderBy(F.desc("mean_abs"), "feature")
    return table.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def importance_table(table: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS) -> DataFrame:
    """Features with their label and percent of the largest, from the largest."""
    label = F.coalesce(map_lookup("feature", labels), F.col("feature"))
    return relative_to_max(table, "mean_abs").withColumn("label", label).orderBy(F.desc("mean_abs"), "feature")


def attribution_trend(df: DataFrame, columns: Sequence[str], coefficients, n: int = 4) -> DataFrame:
    """``quad_fit`` of contribution on feature value for the ``n`` features with the largest mean contribution, by feature."""
    top = top_features(mean_abs_attributions(df, columns, coefficients), n).select("feature").collect()  # n names
    parts = _contributions(columns, coefficients)
    points = df.select(F.inline(F.array(*[
        F.struct(F.lit(r["feature"]).alias("feature"), F.col(r["feature"]).cast("double").alias("x"), parts[r["feature"]].cast("double").alias("contribution"))
        for r in top])))
    return quad_fit(points, "x", "contribution", ["feature"])


def model_coefficients(model, columns: Sequence[str], df: DataFrame) -> dict[str, tuple[float, float]]:
    """Slopes of a fitted linear model with the column means, a number pair per input."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: (float(b), float(means[c] or 0.0)) for c, b in zip(columns, model.coefficients)}
