"""Queries that write tables with the library's sinks and read them back with its sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.operators import cleaning as C
from annualis.operators import scoring as P
from annualis.operators import stats
from annualis.plans import q_series
from annualis.plans import views as V
from annualis.plans.catalog import ORACLE, query
from annualis.plans.q_cleaning import CLEAN, dirty_series
from annualis.plans.q_joins import SCORED, formula_model
from annualis.schemas import CONFIDENCE, MODEL_NAME
from annualis.session import scratch_path
from annualis.sources import key_index, readers, sinks


def _year(df):
    return df.withColumn("year", F.col("year").cast("bigint"))


@query(f"WITH {CLEAN} SELECT area, year, value_tonnes FROM clean")
def csv_ingest(spark, sf):
    """Raw text files to a clean table stored by year."""
    raw, clean = scratch_path(spark, "raw-csv"), scratch_path(spark, "clean")
    dirty_series(spark, sf).write.option("header", True).csv(raw)
    sinks.write_partitioned(C.clean_series(readers.read_series_csv(spark, raw)), clean, "year", ["area"])
    return _year(readers.read_table(spark, clean))


@query(ORACLE["series_features"])
def stored_features(spark, sf):
    """Features stored by year and read back; the year comes from the folder."""
    path = scratch_path(spark, "features")
    sinks.write_partitioned(V.features(spark, sf), path, "year", ["area"])
    return _year(readers.read_table(spark, path))


@query(f"""WITH {V.SERIES} SELECT area, CAST(year AS BIGINT) AS year,
  CASE WHEN year >= 2000 THEN value_tonnes * 2e0 ELSE value_tonnes END AS value_tonnes FROM series""")
def refresh_years(spark, sf):
    """Replace some years of a stored table and leave the others as they are."""
    path = scratch_path(spark, "series")
    whole = V.stored_series(spark, sf)
    sinks.write_partitioned(whole, path)
    newer = whole.filter(F.col("year") >= 2000).withColumn("value_tonnes", F.col("value_tonnes") * F.lit(2.0))
    sinks.write_partitioned(newer, path, only_present=True)
    return _year(readers.read_table(spark, path))


@query("SELECT count(*) AS observed, count(*) AS stored FROM orders")
def observed_count(spark, sf):
    """Rows counted by the job that writes them, against the rows found afterwards."""
    path = scratch_path(spark, "orders")
    counted, seen = sinks.with_row_count(V.table(spark, sf, "orders"))
    counted.write.parquet(path)
    found = stats.count_rows(spark.read.parquet(path), "stored")
    return found.select(F.lit(int(seen.get["n"])).cast("bigint").alias("observed"), "stored")


@query(f"""WITH {SCORED} SELECT parcel_id, 'yield-xgboost' AS model_name, '7' AS model_version, predicted_yield, irrigation_rec_mm,
  0.8643e0 AS confidence FROM scored""")
def prediction_log(spark, sf):
    path = scratch_path(spark, "log")
    scored, _ = P.score(V.requests(spark, sf), V.features(spark, sf), formula_model, digits=None)
    sinks.log_predictions(scored, path, MODEL_NAME, CONFIDENCE, "7")
    out = spark.read.parquet(path).drop("predicted_at")
    return V.round_features(out, {"predicted_yield": 3, "irrigation_rec_mm": 1})


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def idempotent_append(spark, sf):
    """A second load of the same orders, and of all orders after some, adds only what is new."""
    path = scratch_path(spark, "appended")
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    open_orders = V.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select(*orders.columns)
    for load in (open_orders, open_orders, orders):
        sinks.append_new(load, path, ["o_orderkey"])
    return spark.read.parquet(path)


def _orders_by_year(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders")
def indexed_append(spark, sf):
    """Loads that overlap, into a table whose key index says which years must be read."""
    orders = _orders_by_year(spark, sf)
    table = key_index.indexed_table(orders, scratch_path(spark, "indexed"), ["o_orderkey"], "year")
    for load in (orders.filter("year < 1997"), orders.filter("year between 1995 and 1997"), orders):
        key_index.append_indexed(load, table)
    return _year(key_index.read_rows(spark, table))


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) FILTER (year(o_orderdate) >= 1996) AS held, true AS all_asked, true AS few_more
FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1""")
def indexed_append_reads(spark, sf):
    """Keys the index asks for in each year's folder: all that are held there, and few others."""
    orders = _orders_by_year(spark, sf)
    table = key_index.indexed_table(orders, scratch_path(spark, "indexed"), ["o_orderkey"], "year")
    key_index.append_indexed(orders.filter("year < 1998"), table)
    load = orders.filter("year >= 1996")
    asked = key_index.may_hold(spark, table, load.select("o_orderkey")).select("o_orderkey", F.col("_part").alias("year"))
    held = key_index.read_rows(spark, table).select("o_orderkey", "year").join(
        load.select(F.col("o_orderkey").alias("_key")), F.col("o_orderkey") == F.col("_key"), "left")
    both = held.join(asked.withColumn("_asked", F.lit(True)), ["o_orderkey", "year"], "full")
    wanted, hit = F.col("_key").isNotNull(), F.col("_asked").isNotNull()
    counts = both.groupBy("year").agg(F.count_if(wanted).alias("held"), F.count_if(wanted & hit).alias("_found"), F.count_if(~wanted & hit).alias("_more"))
    few = F.col("_more") <= 5 + 0.001 * load.count()
    return counts.select(F.col("year").cast("bigint"), "held", (F.col("_found") == F.col("held")).alias("all_asked"), few.alias("few_more"))


@query(ORACLE["forecast_trend"].replace("SELECT area, CAST(year AS BIGINT) AS year, strftime", "SELECT area, strftime"))
def forecast_documents(spark, sf):
    """Forecasts as JSON documents per entity, read back whole."""
    from annualis.operators.forecast import forecast_trend as run

    path = scratch_path(spark, "forecast")
    sinks.write_forecast_json(run(q_series._scaled(spark, sf), cutoff=1999, digits=None), path)
    out = readers.read_forecast(spark, path).drop("area_key")
    return V.round_features(out, {"yhat": 6, "yhat_lower": 6, "yhat_upper": 6})


@query(f"""WITH {V.PREDICTED} SELECT 'run-1' AS run_id, 'metric' AS kind, 'n' AS name, CAST(count(*) AS VARCHAR) AS value FROM predicted
UNION ALL SELECT 'run-1', 'metric', 'max_y', CAST(max(y) AS VARCHAR) FROM predicted
UNION ALL SELECT 'run-1', 'param', 'depth', '6'""")
def run_record(spark, sf):
    path = scratch_path(spark, "runs")
    predicted = V.predicted_orders(spark, sf)
    metrics = predicted.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("max_y"))
    sinks.log_run(metrics, path, "run-1", {"depth": 6})
    return spark.read.parquet(path).drop("start_time")
