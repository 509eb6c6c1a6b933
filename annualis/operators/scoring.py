"""Response score, irrigation need and scoring of request tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.functions.scalar import as_col, clamp_min, hashed_normal, map_lookup, rounded
from annualis.operators.boosting import Booster
from annualis.operators.cleaning import split_valid
from annualis.operators.joins import enrich_requests
from annualis.operators.modelling import encode
from annualis.schemas import CROP_CLASSES, DEFAULT_WATER_NEED_MM, FEATURES, RESPONSE_COEFFICIENTS, RESPONSE_CONFIG, WATER_NEED_MM


def response_expr(base: Column, opt_temp: Column, opt_rain: Column, intensity="value_normalized", ph="soil_ph",
                  moisture="soil_moisture", nitrogen="nitrogen_ppm", temp="air_temp_c", rain="rainfall_mm",
                  noise: Column | None = None) -> Column:
    """Expected outcome: the class base times one plus a weighted sum of terms, not below the least outcome.

    Terms and weights are those of ``RESPONSE_COEFFICIENTS``: the logarithm of intensity, moisture and nitrogen, and squared
    distances from the best acidity and from the class's best temperature and rain.
    """
    k = RESPONSE_COEFFICIENTS
    square = lambda x, best: (as_col(x) - best) * (as_col(x) - best)
    terms = [
        (k["intensity_gain"], F.log1p(as_col(intensity) * F.lit(k["intensity_rate"]))), (k["ph"], square(ph, F.lit(k["best_ph"]))),
        (k["moisture"], as_col(moisture)), (k["nitrogen"], as_col(nitrogen)), (k["temperature"], square(temp, opt_temp)),
        (k["rain"], square(rain, opt_rain)),
    ]
    share = F.lit(1.0 + k["climate"])
    for weight, term in terms:
        share = share + F.lit(weight) * term
    total = base * share
    return clamp_min(total if noise is None else total + noise, k["least"])


def response_score(df: DataFrame, config: Mapping[str, Sequence[float]] = RESPONSE_CONFIG, crop="crop_type",
                   name: str = "score", digits: int | None = 3, noise_seed: int | None = None,
                   noise_key: str | None = None, **columns) -> DataFrame:
    """Add the response score; an unknown class gives NULL.

    Noise has a deviation of a share of the class base and comes from a hash of
    ``noise_key``, so it does not change with the partitioning.
    """
    base, temp, rain = (map_lookup(crop, {c: float(v[i]) for c, v in config.items()}) for i in range(3))
    noise = None
    if noise_seed is not None:
        noise = F.lit(RESPONSE_COEFFICIENTS["noise"]) * base * hashed_normal(noise_key, noise_seed)
    return df.withColumn(name, rounded(response_expr(base, temp, rain, noise=noise, **columns), digits))


def irrigation(df: DataFrame, needs: Mapping[str, float] = WATER_NEED_MM, default: float = DEFAULT_WATER_NEED_MM,
               crop="crop_type", rain="rainfall_mm", name="irrigation_rec_mm", digits: int | None = 1) -> DataFrame:
    """Water need of the class less the rainfall, not below 0."""
    gap = map_lookup(crop, needs, default) - F.col(rain)
    return df.withColumn(name, rounded(clamp_min(gap, 0.0), digits))


Model = Booster | Transformer | Callable[[DataFrame], DataFrame]


def predict(df: DataFrame, model: Model, name: str = "predicted_yield", digits: int | None = 3) -> DataFrame:
    """Model output as ``name``, not below 0. A model is a booster, a fitted transformer, or adds ``prediction`` itself."""
    if isinstance(model, Booster):
        out = model.transform(df)
    elif isinstance(model, Transformer):
        from annualis.operators.modelling import assemble

        out = model.transform(assemble(df, FEATURES)).drop("features")
    else:
        out = model(df)
    return out.withColumn(name, rounded(clamp_min("prediction", 0.0), digits)).drop("prediction")


def score(requests: DataFrame, features: DataFrame, model: Model, classes: Sequence[str] = CROP_CLASSES,
          digits: int | None = 3, unique_features: bool = False) -> tuple[DataFrame, DataFrame]:
    """Validate, enrich, encode, predict and add the irrigation need; returns (scored, rejects)."""
    good, rejects = split_valid(requests, "crop_type", classes)
    wide = encode(enrich_requests(good, features, unique=unique_features), classes)
    scored = irrigation(predict(wide, model, digits=digits), digits=None if digits is None else 1)
    return scored, rejects
