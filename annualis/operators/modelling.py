"""Feature matrix, repeatable splits, boosted trees, cross-validation and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.functions.scalar import encode_class, text_hash
from annualis.operators.boosting import Booster, fit, fit_together, predict_by
from annualis.operators.cleaning import fill_features
from annualis.operators.stats import fold_summary, regression_metrics
from annualis.schemas import CROP_CLASSES, FEATURES, TARGET
from annualis.session import stored


def encode(df: DataFrame, classes: Sequence[str] = CROP_CLASSES, crop="crop_type") -> DataFrame:
    """Add ``crop_encoded`` from the persisted class list; an unknown class gives NULL."""
    return df.withColumn("crop_encoded", encode_class(crop, classes))


def observed_classes(df: DataFrame, crop="crop_type") -> DataFrame:
    """Classes found in the data with their alphabetical code; persist this list with the model."""
    found = df.select(crop).distinct().filter(F.col(crop).isNotNull())
    code = F.row_number().over(Window.orderBy(crop)) - 1  # over the class list, not over the rows
    return found.select(crop, code.alias("code"))


def feature_matrix(df: DataFrame, target: str = TARGET, classes: Sequence[str] = CROP_CLASSES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """The 13 inputs in fixed order with NULL and NaN as 0, then the target as it is, then ``keep``."""
    wide = encode(df, classes).select(*FEATURES, target, *keep)
    return fill_features(wide, FEATURES)


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add the ``features`` vector; rows keep their other columns."""
    filled = fill_features(df, columns)
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(filled)


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """A number below 2 ** 60 from the text of the keys and the seed; NULL is empty text."""
    return text_hash(seed, *[F.col(k) for k in keys])


def with_fold(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 1..k from a hash of the row key, the same for every partitioning."""
    return df.withColumn(name, row_hash(keys, seed) % F.lit(k) + 1)


def split_random(df: DataFrame, keys: Sequence[str], share: float = 0.2, seed: int = 42,
                 name: str = "is_test") -> DataFrame:
    """Mark about ``share`` of the rows as test rows, by a hash of the row key."""
    point = row_hash(keys, seed) % F.lit(1_000_000)
    return df.withColumn(name, point < F.lit(int(share * 1_000_000)))


def fit_yield(matrix: DataFrame, params: Mapping[str, float] | None = None, target: str = TARGET, keys: Sequence[str] = ()) -> Booster:
    """Fit boosted trees on a feature matrix, with ``BOOST_PARAMS`` but for ``params``; ``keys`` name its rows, without them all their values do."""
    return fit(matrix, FEATURES, target, keys or [*FEATURES, target], params)


def fit_linear(matrix: DataFrame, target: str = TARGET, columns: Sequence[str] = FEATURES, ridge: float = 0.0):
    """Linear model on the same matrix, from its normal equations."""
    model = LinearRegression(labelCol=target, featuresCol="features", regParam=ridge, solver="normal")
    return model.fit(assemble(matrix, columns))


def cross_validate(matrix: DataFrame, k: int = 5, params: Mapping[str, float] | None = None, target: str = TARGET,
                   fold: str = "fold", keys: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold predictions for every row, by ``k`` models of the other folds that are grown together.

    ``matrix`` carries the fold column; store it before the call. A row of no fold from 1 to ``k`` has none.
    """
    parts = {f"fold {i}": F.col(fold) != i for i in range(1, k + 1)}
    models = fit_together(matrix, FEATURES, target, keys or [*FEATURES, target], parts, params)
    return predict_by(matrix, {i: models[f"fold {i}"] for i in range(1, k + 1)}, fold)


def fold_metrics(predicted: DataFrame, target: str = TARGET, fold: str = "fold") -> DataFrame:
    """RMSE, MAE, R2 and row count per fold."""
    return regression_metrics(predicted, target, "prediction", [fold]).select(fold, "rmse", "mae", "r2", "n")


def cv_summary(predicted: DataFrame, target: str = TARGET, ddof: int = 0) -> DataFrame:
    """Mean and spread of the fold RMSE and R2."""
    return fold_summary(fold_metrics(predicted, target), ["rmse", "r2"], ddof)


def importances(spark, model: Booster, digits: int = 4) -> DataFrame:
    """Feature importances by name, largest first: each feature's mean gain of a split, as a share of all; as many rows as there are features."""
    rows = [(r.feature, round(float(r.importance), digits)) for r in model.gains().itertuples()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_importances(table: DataFrame, n: int = 3) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def train_run(matrix: DataFrame, keys: Sequence[str], share: float = 0.2, k: int = 5, seed: int = 42,
              params: Mapping[str, float] | None = None, target: str = TARGET, top: int = 3) -> tuple[Booster, DataFrame]:
    """A model and one row about it: split, cross-validation on the training part, fit, test metrics, counts, importances.

    The model and those of the folds grow together. The spread over folds is the population deviation. Log the row with ``sinks.log_run``.
    """
    spark = matrix.sparkSession
    marked = stored(with_fold(split_random(matrix, keys, share, seed), keys, k, seed + 1), "marked")
    train, test = marked.filter(~F.col("is_test")), marked.filter(F.col("is_test"))
    parts = {"model": F.lit(True), **{f"fold {i}": F.col("fold") != i for i in range(1, k + 1)}}
    models = fit_together(train, FEATURES, target, keys, parts, params)
    model = models["model"]
    folds = cv_summary(predict_by(train, {i: models[f"fold {i}"] for i in range(1, k + 1)}, "fold"), target).first()
    scores = regression_metrics(model.transform(test), target, "prediction").first()
    best = top_importances(importances(spark, model), top).collect()
    row = {"train_rows": train.count(), "test_rows": scores["n"], **{f"test_{c}": scores[c] for c in ("rmse", "mae", "r2", "bias")},
           **{f"cv_{c}": folds[c] for c in ("rmse_mean", "rmse_std", "r2_mean", "r2_std")},
           **{f"importance_{r['feature']}": r["importance"] for r in best}}
    kinds = ", ".join(f"`{c}` {'long' if c.endswith('_rows') else 'double'}" for c in row)
    return model, spark.createDataFrame([tuple(row.values())], kinds)
