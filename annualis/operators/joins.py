"""Joins of entities, measurements, outcomes and features.

No join carries a broadcast hint: dimension sides are scans or stored tables, whose
size Spark knows and tests against ``spark.sql.autoBroadcastJoinThreshold``. Above it
the join is sort-merge, and AQE splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.functions.scalar import jan_first
from annualis.operators.cleaning import check_limit
from annualis.operators.ordered import pick_first
from annualis.schemas import MEASURES, MISSING_IN_SERVING, MISSING_IN_SIMULATION, SERIES_INPUTS, TARGET
from annualis.session import stored


def training_set(readings: DataFrame, parcels: DataFrame, outcomes: DataFrame, features: DataFrame,
                 defaults: Mapping[str, float] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Readings with class and country, the outcome of the same parcel and year, and series features.

    Every reading of a year meets that year's outcome. Parcel and outcome are inner
    joins, features a left join on (country, year). Outcomes, the smaller table, take on
    the other columns first, so the readings are shuffled by one join only. ``defaults`` fills feature columns
    after the join; only growth by default. ``extra`` keeps further reading columns.
    """
    if defaults is None:
        defaults = {"yoy_growth_pct": 0.0}
    sensed = readings.select("parcel_id", F.year("recorded_at").alias("year"), *MEASURES, *extra)
    known = outcomes.filter(F.col(TARGET).isNotNull()).select(
        "parcel_id", F.col("harvest_year").alias("year"), TARGET
    )
    entity = parcels.select(F.col("id").alias("parcel_id"), "crop_type", "country")
    series = features.select(F.col("area").alias("country"), "year", *SERIES_INPUTS)
    described = known.join(entity, "parcel_id").join(series, ["country", "year"], "left")
    joined = sensed.join(described, ["parcel_id", "year"])
    inputs = [
        F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in SERIES_INPUTS
    ]
    return joined.select("crop_type", "country", "year", *MEASURES, *inputs, TARGET, *extra)


def lookup_join(df: DataFrame, dim: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join that fills the looked-up columns when no row matches or the value is NULL."""
    joined = df.join(dim.select(*keys, *defaults), list(keys), "left")
    filled = [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()]
    return joined.select(*[c for c in df.columns if c not in defaults], *filled)


def intensity_lookup(df: DataFrame, features: DataFrame, default: float = MISSING_IN_SIMULATION) -> DataFrame:
    """Normalised series value of (country, year), ``default`` where there is none."""
    dim = features.select(F.col("area").alias("country"), "year", "value_normalized")
    return lookup_join(df, dim, ["country", "year"], {"value_normalized": default})


def unique_features(dim: DataFrame, order: Sequence[str] = ("value_tonnes",)) -> DataFrame:
    """One stored row per (country, year), the smallest by ``order``; a row with a value comes before one without."""
    known = [e for o in order for e in (F.col(o).isNull(), F.col(o))]
    return stored(pick_first(dim, ["country", "year"], known), "unique-features")


def enrich_requests(requests: DataFrame, features: DataFrame, default: float = MISSING_IN_SERVING,
                    order: Sequence[str] = ("value_tonnes",), unique: bool = False) -> DataFrame:
    """Series features for a table of requests, ``default`` where (country, year) is unknown.

    The feature side is reduced to one row per key, so a request never multiplies;
    ``unique=True`` skips this for a table whose key is known to be unique.
    """
    dim = features.select(F.col("area").alias("country"), "year", *SERIES_INPUTS)
    if not unique:
        dim = unique_features(dim, order)
    return lookup_join(requests, dim, ["country", "year"], {c: default for c in SERIES_INPUTS})


def prediction_history(log: DataFrame, parcels: DataFrame, limit: int = 50) -> DataFrame:
    """The latest ``limit`` (at most 500) log rows with the attributes of their parcel.

    Rows without a parcel vanish. Ties on time go to the larger id. ``id`` is unique
    in either table. The log is read once: each task keeps its latest ``limit`` rows with a known
    parcel, and the ``limit`` rows left are broadcast to fetch the attributes.
    """
    check_limit(limit)
    known = parcels.select(F.col("id").alias("parcel_id"))
    latest = log.join(known, "parcel_id", "left_semi").orderBy(F.desc("predicted_at"), F.desc("id")).limit(limit)
    entity = parcels.select(F.col("id").alias("parcel_id"), F.col("name").alias("parcel_name"), "crop_type", "country")
    return (
        entity.join(F.broadcast(latest), "parcel_id")
        .select("id", "parcel_id", "parcel_name", "crop_type", "country", "model_name", "model_version",
                "predicted_yield", "irrigation_rec_mm", "confidence", "predicted_at")
        .orderBy(F.desc("predicted_at"), F.desc("id"))
        .limit(limit)
    )


def list_entities(parcels: DataFrame) -> DataFrame:
    columns = ["id", "name", "crop_type", "area_ha", "soil_type", "country", "latitude", "longitude"]
    return parcels.select(*columns).orderBy("id")


def spine(entities: DataFrame, first: int, last: int, ord: str = "year", copies: int = 1,
          copy_name: str | None = None) -> DataFrame:
    """Every entity with every period from ``first`` to ``last``, and with ``copies`` indexes if named.

    Generated per row, without a join.
    """
    out = entities.withColumn(ord, F.explode(F.sequence(F.lit(first), F.lit(last))))
    if copy_name:
        out = out.withColumn(copy_name, F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return out


def overlay(history: DataFrame, forecast: DataFrame, key="area", ord="year", v="value_tonnes") -> DataFrame:
    """History and forecast on one time axis: ``kind`` tells them apart, ``ds`` is January first."""
    past = history.select(
        key, jan_first(F.col(ord)).alias("ds"), F.lit("history").alias("kind"), F.col(v).alias("value"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
    )
    ahead = forecast.select(
        key, jan_first(F.col(ord)).alias("ds"), F.lit("forecast").alias("kind"), F.col("yhat").alias("value"),
        F.col("yhat_lower").alias("lower"), F.col("yhat_upper").alias("upper"),
    )
    return past.unionByName(ahead)
