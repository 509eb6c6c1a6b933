"""The library's tables, derived from the given ones; each with its SQL as a CTE.

Money is summed in whole cents, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annualis.functions.scalar import map_lookup, round_arith
from annualis.operators.series import series_features
from annualis.plans.catalog import sql_round
from annualis.session import stored
from annualis.sources.readers import read_table

SEGMENT_CROP = {
    "AUTOMOBILE": "corn", "BUILDING": "rice", "FURNITURE": "soybean", "HOUSEHOLD": "sunflower", "MACHINERY": "wheat",
}
SOILS = {0: "loam", 1: "clay", 2: "sandy loam", 3: "silt loam"}


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    df = read_table(spark, path, _schemas.get(path))
    _schemas.setdefault(path, df.schema)
    return df


def cents(c: str) -> Column:
    return F.floor(F.col(c) * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def customer_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x order year with gaps: (area bigint, year, value_tonnes)."""
    orders = table(spark, sf_dir, "orders")
    sums = orders.groupBy(F.col("o_custkey").alias("area"), F.year("o_orderdate").alias("year")).agg(
        F.sum(cents("o_totalprice")).alias("c"))
    return sums.select("area", "year", F.col("c").cast("double").alias("value_tonnes"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation x order year. Orders collapse to customer and year before the join, so no customer is a hot key."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("area"), "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    by_nation = (
        customer_series(spark, sf_dir).join(customer, "area").groupBy("c_nationkey", "year")
        .agg(F.sum("value_tonnes").alias("value_tonnes"))
    )
    named = by_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(F.col("n_name").alias("area"), "year", "value_tonnes")


def stored_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean series as a stored table, the form in which the feature step reads it."""
    return stored(series(spark, sf_dir), "series")


FEATURE_DIGITS = {
    "yoy_growth_pct": 2, "ma5_tonnes": 2, "cagr_5y_pct": 2, "value_normalized": 4, "pct_vs_global_avg": 2,
}


def round_features(df: DataFrame, digits=None) -> DataFrame:
    """Round the features by arithmetic, so that both engines agree on ties."""
    digits = digits or FEATURE_DIGITS
    return df.withColumns({c: round_arith(c, d) for c, d in digits.items() if c in df.columns})


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series with its features, stored: one row per nation and year."""
    return stored(round_features(series_features(stored_series(spark, sf_dir), rounding=False)), "features")


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        map_lookup("c_mktsegment", SEGMENT_CROP).alias("crop_type"),
        (F.col("c_acctbal") + F.lit(1000.0)).alias("area_ha"),
        (F.col("c_nationkey") * F.lit(5.0) - F.lit(60.0)).alias("latitude"),
        (F.col("c_nationkey") * F.lit(14.0) - F.lit(170.0)).alias("longitude"),
        map_lookup(F.col("c_nationkey") % 4, SOILS).alias("soil_type"),
        F.col("n_name").alias("country"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line sums per order, in whole units."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.sum(cents("l_discount")).alias("disc"),
        F.sum(cents("l_tax")).alias("tax"),
        F.sum(cents("l_extendedprice")).alias("price"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have lines, with their line sums. Lines collapse per order before the join."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parcel_id"),
        F.col("o_orderdate").alias("recorded_at"), "o_totalprice")
    return orders.join(order_lines(spark, sf_dir), "id")


def readings(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """One reading per order that has lines."""
    joined = order_facts(spark, sf_dir) if facts is None else facts
    temp = F.lit(5.0) + (F.col("price") / F.col("n")) / F.lit(5e5)
    return joined.select(
        "id", "parcel_id", "recorded_at",
        (F.lit(0.2) + (F.col("disc") / F.col("n")) * F.lit(0.05)).alias("soil_moisture"),
        temp.alias("soil_temp_c"),
        (F.lit(5.5) + (F.col("tax") / F.col("n")) * F.lit(0.25)).alias("soil_ph"),
        (F.lit(20.0) + (F.col("qty") / F.col("n")) * F.lit(4.0)).alias("nitrogen_ppm"),
        temp.alias("air_temp_c"),
        (F.lit(40.0) + F.col("n") * F.lit(5.0)).alias("humidity_pct"),
        (F.col("o_totalprice") / F.lit(400.0)).alias("rainfall_mm"),
        (F.lit(120.0) + F.month("recorded_at") * F.lit(10.0)).alias("solar_rad_wm2"),
    )


def outcomes(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Quantity per customer and order year."""
    joined = order_facts(spark, sf_dir) if facts is None else facts
    sums = joined.groupBy("parcel_id", F.year("recorded_at").alias("harvest_year")).agg(F.sum("qty").alias("qty"))
    return sums.select("parcel_id", "harvest_year", (F.col("qty") / F.lit(100.0)).alias("yield_t_per_ha"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def with_k(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def requests(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    """Scoring requests out of events; those of type ``error`` carry an unknown class."""
    source = with_k(events(spark, sf_dir) if stream is None else stream)
    entity = parcels(spark, sf_dir).select("id", F.col("crop_type").alias("_crop"), "country")
    joined = source.join(entity, F.col("user_id") == F.col("id"))
    k = F.col("k")
    return joined.select(
        "event_id", "ts", F.col("user_id").alias("parcel_id"),
        F.when(F.col("event_type") == "error", F.lit("banana")).otherwise(F.col("_crop")).alias("crop_type"),
        (F.lit(1995) + k % 9).cast("int").alias("year"),
        (F.lit(0.2) + k * F.lit(0.005)).alias("soil_moisture"),
        (F.lit(5.5) + k * F.lit(0.02)).alias("soil_ph"),
        (F.lit(40.0) + k * F.lit(1.5)).alias("nitrogen_ppm"),
        (F.lit(5.0) + k * F.lit(0.25)).alias("air_temp_c"),
        (F.lit(40.0) + k * F.lit(0.5)).alias("humidity_pct"),
        (F.col("value") * F.lit(8.0)).alias("rainfall_mm"),
        (F.lit(120.0) + k).alias("solar_rad_wm2"),
        "country",
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("parcel_id"), F.col("ts").alias("predicted_at"),
        F.lit("yield-xgboost").alias("model_name"), F.col("event_type").alias("model_version"),
        F.col("value").alias("predicted_yield"), (F.col("value") * F.lit(2.0)).alias("irrigation_rec_mm"),
        F.lit(0.8643).alias("confidence"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs out of events: the type is the experiment."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("experiment"), F.col("event_id").alias("run_id"), F.col("ts").alias("start_time"),
        F.col("value").alias("rmse"), (F.col("value") * F.lit(0.75)).alias("mae"),
        (F.lit(1.0) - F.col("value") / F.lit(1000.0)).alias("r2"),
    )


def predicted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an actual and a predicted value: price against quantity times a flat price."""
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").cast("bigint").alias("year"), "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("y"), (F.col("l_quantity") * F.lit(2.0)).alias("yhat"),
    ).withColumn("residual", F.col("y") - F.col("yhat"))


# --- the same tables in SQL ---------------------------------------------------


def _case(column: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


_CENTS = "CAST(floor({0} * 100e0 + 0.5e0) AS BIGINT)"


def _c(column: str) -> str:
    return _CENTS.format(column)


CUSTOMER_SERIES = f"""customer_series AS (
  SELECT o_custkey AS area, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum({_c('o_totalprice')}) AS DOUBLE) AS value_tonnes
  FROM orders GROUP BY 1, 2)"""

SERIES = f"""series AS (
  SELECT n_name AS area, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum({_c('o_totalprice')}) AS DOUBLE) AS value_tonnes
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def wide_cte(source: str, key: str = "area", ord: str = "year", v: str = "value_tonnes", period: str = "year") -> str:
    return f"""wide AS (
  SELECT *, lag({v}, 1) OVER w AS prev, lag({v}, 5) OVER w AS base,
         avg({v}) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean5,
         min({v}) OVER (PARTITION BY {key}) AS low, max({v}) OVER (PARTITION BY {key}) AS high,
         avg({v}) OVER (PARTITION BY {period}) AS period_avg
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {ord}))"""


def feature_exprs(v: str = "value_tonnes") -> dict[str, str]:
    return {
        "yoy_growth_pct": sql_round(f"(CASE WHEN prev <> 0 THEN ({v} - prev) / prev * 100e0 END)", 2),
        "ma5_tonnes": sql_round("mean5", 2),
        "cagr_5y_pct": sql_round(f"(CASE WHEN base > 0 THEN (pow({v} / base, 0.2e0) - 1e0) * 100e0 END)", 2),
        "value_normalized": sql_round(f"(({v} - low) / (CASE WHEN high - low = 0 THEN 1e0 ELSE high - low END))", 4),
        "pct_vs_global_avg": sql_round(f"(CASE WHEN period_avg > 0 THEN ({v} - period_avg) / period_avg * 100e0 END)", 2),
    }


def _select(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


FEATURES_CTE = f"""{SERIES}, {wide_cte('series')}, features AS (
  SELECT area, year, value_tonnes, {_select(feature_exprs())} FROM wide)"""

PARCELS = f"""parcels AS (
  SELECT c_custkey AS id, c_name AS name, {_case('c_mktsegment', SEGMENT_CROP)} AS crop_type,
         c_acctbal + 1000e0 AS area_ha, c_nationkey * 5e0 - 60e0 AS latitude, c_nationkey * 14e0 - 170e0 AS longitude,
         {_case('c_nationkey % 4', SOILS)} AS soil_type, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ORDER_LINES = f"""order_lines AS (
  SELECT l_orderkey AS id, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
         CAST(sum({_c('l_discount')}) AS BIGINT) AS disc, CAST(sum({_c('l_tax')}) AS BIGINT) AS tax,
         CAST(sum({_c('l_extendedprice')}) AS BIGINT) AS price
  FROM lineitem GROUP BY 1)"""

READINGS = f"""{ORDER_LINES}, readings AS (
  SELECT o_orderkey AS id, o_custkey AS parcel_id, o_orderdate AS recorded_at,
         0.2e0 + (disc / n) * 0.05e0 AS soil_moisture, 5e0 + (price / n) / 5e5 AS soil_temp_c,
         5.5e0 + (tax / n) * 0.25e0 AS soil_ph, 20e0 + (qty / n) * 4e0 AS nitrogen_ppm,
         5e0 + (price / n) / 5e5 AS air_temp_c, 40e0 + n * 5e0 AS humidity_pct, o_totalprice / 400e0 AS rainfall_mm,
         120e0 + month(o_orderdate) * 10e0 AS solar_rad_wm2
  FROM orders JOIN order_lines ON o_orderkey = order_lines.id)"""

OUTCOMES = """outcomes AS (
  SELECT o_custkey AS parcel_id, CAST(year(o_orderdate) AS INTEGER) AS harvest_year,
         CAST(sum(qty) AS BIGINT) / 100e0 AS yield_t_per_ha
  FROM orders JOIN order_lines ON o_orderkey = order_lines.id GROUP BY 1, 2)"""

TRAINING = f"""{FEATURES_CTE}, {PARCELS}, {READINGS}, {OUTCOMES}, training AS (
  SELECT r.id AS reading_id, p.crop_type, p.country, CAST(year(r.recorded_at) AS INTEGER) AS year, r.soil_moisture,
         r.soil_ph, r.nitrogen_ppm, r.air_temp_c, r.humidity_pct, r.rainfall_mm, r.solar_rad_wm2, f.value_tonnes,
         coalesce(f.yoy_growth_pct, 0e0) AS yoy_growth_pct, f.ma5_tonnes, f.value_normalized, o.yield_t_per_ha
  FROM readings r JOIN parcels p ON p.id = r.parcel_id
  JOIN outcomes o ON o.parcel_id = r.parcel_id AND o.harvest_year = year(r.recorded_at)
  LEFT JOIN features f ON f.area = p.country AND f.year = year(r.recorded_at)
  WHERE o.yield_t_per_ha IS NOT NULL)"""

MATRIX = f"""{TRAINING}, matrix AS (
  SELECT reading_id, crop_type, country,
         CASE crop_type WHEN 'corn' THEN 0 WHEN 'rice' THEN 1 WHEN 'soybean' THEN 2 WHEN 'sunflower' THEN 3
           WHEN 'wheat' THEN 4 END AS crop_encoded,
         year, soil_moisture, soil_ph, nitrogen_ppm, air_temp_c, humidity_pct, rainfall_mm, solar_rad_wm2,
         coalesce(value_tonnes, 0e0) AS value_tonnes, coalesce(yoy_growth_pct, 0e0) AS yoy_growth_pct,
         coalesce(ma5_tonnes, 0e0) AS ma5_tonnes, coalesce(value_normalized, 0e0) AS value_normalized, yield_t_per_ha
  FROM training)"""

EVENTS_K = """ev AS (
  SELECT *, CAST(regexp_extract(props, '-?[0-9]+') AS INTEGER) AS k FROM events)"""

REQUESTS = f"""{EVENTS_K}, requests AS (
  SELECT event_id, ts, user_id AS parcel_id,
         CASE WHEN event_type = 'error' THEN 'banana' ELSE p.crop_type END AS crop_type,
         CAST(1995 + k % 9 AS INTEGER) AS year, 0.2e0 + k * 0.005e0 AS soil_moisture, 5.5e0 + k * 0.02e0 AS soil_ph,
         40e0 + k * 1.5e0 AS nitrogen_ppm, 5e0 + k * 0.25e0 AS air_temp_c, 40e0 + k * 0.5e0 AS humidity_pct,
         value * 8e0 AS rainfall_mm, 120e0 + k AS solar_rad_wm2, p.country
  FROM ev JOIN parcels p ON user_id = p.id)"""

PREDICTION_LOG = """prediction_log AS (
  SELECT event_id AS id, user_id AS parcel_id, ts AS predicted_at, 'yield-xgboost' AS model_name,
         event_type AS model_version, value AS predicted_yield, value * 2e0 AS irrigation_rec_mm,
         0.8643e0 AS confidence
  FROM events)"""

RUNS = """runs AS (
  SELECT event_type AS experiment, event_id AS run_id, ts AS start_time, value AS rmse, value * 0.75e0 AS mae,
         1e0 - value / 1000e0 AS r2
  FROM events)"""

PREDICTED = """predicted AS (
  SELECT *, y - yhat AS residual FROM (
    SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS BIGINT) AS year, l_orderkey, l_linenumber,
           l_extendedprice / 1000e0 AS y, l_quantity * 2e0 AS yhat
    FROM lineitem))"""
