"""Queries of joins, the training set, scoring and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.functions.scalar import map_lookup
from annualis.operators import joins as J
from annualis.operators import modelling as M
from annualis.operators import runs as R
from annualis.operators import scoring as P
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.schemas import FEATURES, MEASURES, RESPONSE_CONFIG, SERIES_INPUTS, TARGET, WATER_NEED_MM
from annualis.session import stored


def training(spark, sf, extra=("reading_id",), defaults=None) -> DataFrame:
    """Readings and outcomes come from one stored table, so the lines are read and shuffled once."""
    facts = stored(V.order_facts(spark, sf), "facts")
    readings = V.readings(spark, sf, facts).withColumnRenamed("id", "reading_id")
    outcomes = V.outcomes(spark, sf, facts)
    return J.training_set(readings, V.parcels(spark, sf), outcomes, V.features(spark, sf), defaults, extra)


def matrix(spark, sf, keep=("reading_id",)) -> DataFrame:
    full = M.feature_matrix(training(spark, sf), keep=["crop_type", "country", "reading_id"])
    return full.select(*FEATURES, TARGET, *keep)


def _year(df):
    return df.withColumn("year", F.col("year").cast("bigint"))


_TRAIN_COLS = ", ".join(["crop_type", "country", "CAST(year AS BIGINT) AS year", *MEASURES, *SERIES_INPUTS, TARGET, "reading_id"])
_MATRIX_COLS = ", ".join(["CAST(crop_encoded AS BIGINT) AS crop_encoded", "CAST(year AS BIGINT) AS year", *FEATURES[2:], TARGET, "reading_id"])


@query(f"WITH {V.TRAINING} SELECT {_TRAIN_COLS} FROM training")
def training_set(spark, sf):
    return _year(training(spark, sf))


@query(f"WITH {V.TRAINING} SELECT {_TRAIN_COLS.replace('ma5_tonnes', 'coalesce(ma5_tonnes, 0e0) AS ma5_tonnes')} FROM training")
def training_set_filled(spark, sf):
    return _year(training(spark, sf, defaults={c: 0.0 for c in SERIES_INPUTS}))


@query(f"WITH {V.MATRIX} SELECT {_MATRIX_COLS} FROM matrix")
def feature_matrix(spark, sf):
    return _year(matrix(spark, sf)).withColumn("crop_encoded", F.col("crop_encoded").cast("bigint"))


@query(f"""WITH {V.FEATURES_CTE}, {V.PARCELS}, {V.REQUESTS} SELECT event_id, r.country, CAST(r.year AS BIGINT) AS year,
  coalesce(f.value_normalized, 0.3e0) AS value_normalized
FROM requests r LEFT JOIN features f ON f.area = r.country AND f.year = r.year""")
def lookup_default(spark, sf):
    requests = V.requests(spark, sf).select("event_id", "country", "year")
    return _year(J.intensity_lookup(requests, V.features(spark, sf)))


_ENRICHED = f"""{V.FEATURES_CTE}, {V.PARCELS}, {V.REQUESTS}, enriched AS (
  SELECT r.*, coalesce(f.value_tonnes, 0e0) AS value_tonnes, coalesce(f.yoy_growth_pct, 0e0) AS yoy_growth_pct,
    coalesce(f.ma5_tonnes, 0e0) AS ma5_tonnes, coalesce(f.value_normalized, 0e0) AS value_normalized
  FROM requests r LEFT JOIN features f ON f.area = r.country AND f.year = r.year)"""


@query(f"WITH {_ENRICHED} SELECT event_id, value_tonnes, yoy_growth_pct, ma5_tonnes, value_normalized FROM enriched")
def enrich_requests(spark, sf):
    twice = V.features(spark, sf)
    return J.enrich_requests(V.requests(spark, sf), twice.unionByName(twice)).select("event_id", *SERIES_INPUTS)


@query(f"""WITH {V.PARCELS}, {V.PREDICTION_LOG}
SELECT l.id, parcel_id, p.name AS parcel_name, crop_type, country, model_name, model_version, predicted_yield,
  irrigation_rec_mm, confidence, predicted_at FROM prediction_log l JOIN parcels p ON p.id = l.parcel_id
ORDER BY predicted_at DESC, l.id DESC LIMIT 500""")
def prediction_history(spark, sf):
    return J.prediction_history(V.prediction_log(spark, sf), V.parcels(spark, sf), 500)


@query(f"WITH {V.PARCELS} SELECT id, name, crop_type, area_ha, soil_type, country, latitude, longitude FROM parcels ORDER BY id")
def list_entities(spark, sf):
    return J.list_entities(V.parcels(spark, sf))


# --- scoring -----------------------------------------------------------------


def _score_sql(intensity: str) -> str:
    """Response score in SQL; the class settings are base, opt_temp and opt_rain."""
    total = (f"base + base * 0.20e0 * ln(1e0 + {intensity} * 4e0) + base * (-0.06e0 * (soil_ph - 6.5e0) * (soil_ph - 6.5e0)"
             " + 0.04e0 * soil_moisture + 0.0008e0 * nitrogen_ppm) + base * (-0.008e0 * (air_temp_c - opt_temp) * (air_temp_c - opt_temp)"
             " - 0.000008e0 * (rainfall_mm - opt_rain) * (rainfall_mm - opt_rain) + 0.05e0)")
    return sql_round(f"greatest(0.1e0, {total})", 3)


_CONFIG = "config(crop, base, opt_temp, opt_rain) AS (VALUES " + ", ".join(
    f"('{c}', {b}e0, {t}e0, {r}e0)" for c, (b, t, r) in RESPONSE_CONFIG.items()) + ")"
_NEED = f"CASE crop_type {' '.join(f'''WHEN '{c}' THEN {v}e0''' for c, v in WATER_NEED_MM.items())} ELSE 600e0 END"


@query(f"""WITH {V.FEATURES_CTE}, {V.PARCELS}, {V.READINGS}, {_CONFIG}
SELECT r.id, {_score_sql('coalesce(f.value_normalized, 0.3e0)')} AS score
FROM readings r JOIN parcels p ON p.id = r.parcel_id JOIN config ON crop = crop_type
LEFT JOIN features f ON f.area = p.country AND f.year = year(r.recorded_at)""")
def response_score(spark, sf):
    entity = V.parcels(spark, sf).select(F.col("id").alias("parcel_id"), "crop_type", "country")
    sensed = V.readings(spark, sf).withColumn("year", F.year("recorded_at")).join(entity, "parcel_id")
    scored = P.response_score(J.intensity_lookup(sensed, V.features(spark, sf)), digits=None)
    return V.round_features(scored.select("id", "score"), {"score": 3})


@query(f"WITH {V.PARCELS}, {V.REQUESTS} SELECT event_id, {sql_round(f'greatest(0e0, {_NEED} - rainfall_mm)', 1)} AS irrigation_rec_mm FROM requests")
def irrigation(spark, sf):
    out = P.irrigation(V.requests(spark, sf), digits=None).select("event_id", "irrigation_rec_mm")
    return V.round_features(out, {"irrigation_rec_mm": 1})


def formula_model(df: DataFrame) -> DataFrame:
    """The response formula in place of a fitted model."""
    return P.response_score(df, name="prediction", digits=None)


SCORED = f"""{_ENRICHED}, {_CONFIG}, scored AS (
  SELECT event_id, parcel_id, {_score_sql('value_normalized')} AS predicted_yield,
    {sql_round(f'greatest(0e0, {_NEED} - rainfall_mm)', 1)} AS irrigation_rec_mm
  FROM enriched JOIN config ON crop = crop_type)"""


@query(f"WITH {SCORED} SELECT event_id, parcel_id, predicted_yield, irrigation_rec_mm FROM scored")
def batch_score(spark, sf):
    scored, _ = P.score(V.requests(spark, sf), V.features(spark, sf), formula_model, digits=None, unique_features=True)
    out = scored.select("event_id", "parcel_id", "predicted_yield", "irrigation_rec_mm")
    return V.round_features(out, {"predicted_yield": 3, "irrigation_rec_mm": 1})


@query()
def noisy_score(spark, sf):
    entity = V.parcels(spark, sf).select(F.col("id").alias("parcel_id"), "crop_type", "country")
    sensed = V.readings(spark, sf).withColumn("year", F.year("recorded_at")).join(entity, "parcel_id")
    scored = P.response_score(J.intensity_lookup(sensed, V.features(spark, sf)), noise_seed=42, noise_key="id")
    return scored.select("id", "crop_type", "score")


# --- run records ---------------------------------------------------------------


@query(f"""WITH {V.RUNS} SELECT *, CAST(row_number() OVER (PARTITION BY experiment ORDER BY start_time, run_id) AS BIGINT) AS version
FROM runs""")
def run_versions(spark, sf):
    return R.run_versions(V.runs(spark, sf))


@query(f"""WITH {V.RUNS} SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) = 1""")
def latest_run(spark, sf):
    return R.latest_run(V.runs(spark, sf))


@query(f"""WITH {V.RUNS} SELECT experiment,
  first(run_id ORDER BY rmse, run_id) AS best_rmse_version, min(rmse) AS best_rmse,
  first(run_id ORDER BY mae, run_id) AS best_mae_version, min(mae) AS best_mae,
  first(run_id ORDER BY r2 DESC, run_id) AS best_r2_version, max(r2) AS best_r2 FROM runs GROUP BY 1""")
def best_run(spark, sf):
    return R.best_run(V.runs(spark, sf), ["experiment"], version="run_id")


# --- models ----------------------------------------------------------------------

@query()
def split_random(spark, sf):
    return M.split_random(matrix(spark, sf), ["reading_id"]).select("reading_id", "is_test")


@query("SELECT DISTINCT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS code FROM customer")
def observed_classes(spark, sf):
    out = M.observed_classes(V.table(spark, sf, "customer"), "c_mktsegment")
    return out.withColumn("code", F.col("code").cast("bigint"))


@query(f"""SELECT c_custkey, CASE c_mktsegment {' '.join(f"WHEN '{s}' THEN '{c}'" for s, c in V.SEGMENT_CROP.items())} END AS crop_type
FROM customer""")
def crop_of_segment(spark, sf):
    return V.table(spark, sf, "customer").select("c_custkey", map_lookup("c_mktsegment", V.SEGMENT_CROP).alias("crop_type"))


