"""Queries of event rates, bucket histograms and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.operators import rates as R
from annualis.plans import views as V
from annualis.plans.catalog import query
from annualis.plans.q_joins import SCORED, formula_model
from annualis.schemas import CONFIDENCE, LATENCY_BOUNDS, MODEL_NAME
from annualis.session import scratch_path
from annualis.sources.readers import stream_table


@query("SELECT event_type, count(*) AS total FROM events GROUP BY 1")
def counter_total(spark, sf):
    return R.counter_total(V.events(spark, sf), "event_type")


@query("SELECT count(*) AS total FROM events")
def grand_total(spark, sf):
    return R.grand_total(V.events(spark, sf))


@query("""SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
  count(*) AS n, count(*) / 60e0 AS per_second, count(*) * 60e0 / 60e0 AS per_minute FROM events GROUP BY 1, 2""")
def event_rate(spark, sf):
    return R.event_rate(V.events(spark, sf), "1 minute")


@query("""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
  count(*) AS n, count(*) / 3600e0 AS per_second, count(*) * 60e0 / 3600e0 AS per_minute FROM events GROUP BY 1, 2, 3""")
def event_rate_by(spark, sf):
    return R.event_rate(V.events(spark, sf), "1 hour", by=["event_type"])


@query("""SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * i AS window_start, date_trunc('hour', ts) - INTERVAL 1 HOUR * i + INTERVAL 6 HOUR AS window_end,
  count(*) AS n, count(*) / 21600e0 AS per_second, count(*) * 60e0 / 21600e0 AS per_minute
FROM events, range(6) t(i) GROUP BY 1, 2""")
def event_rate_sliding(spark, sf):
    return R.event_rate(V.events(spark, sf), "6 hours", "1 hour")


@query("""WITH m AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS slot, event_type FROM events),
e AS (SELECT min(slot) - INTERVAL 4 MINUTE AS a, max(slot) AS b FROM m),
axis AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MINUTE)) AS s FROM e),
c AS (SELECT slot - INTERVAL 1 MINUTE * i AS s, count(*) AS n FROM m, range(5) t(i) WHERE regexp_matches(event_type, '^err') GROUP BY 1)
SELECT axis.s AS window_start, axis.s + INTERVAL 5 MINUTE AS window_end, coalesce(n, 0) AS n FROM axis LEFT JOIN c ON c.s = axis.s""")
def matching_increase(spark, sf):
    return R.matching_increase(V.events(spark, sf), "event_type", "^err")


def _latency(spark, sf):
    return V.events(spark, sf).select("event_id", "ts", "event_type", (F.col("value") / F.lit(100.0)).alias("seconds"))


_SUMS = ", ".join(f"count(CASE WHEN seconds <= {b} THEN 1 END) AS {R.bucket_name(b)}" for b in LATENCY_BOUNDS)
_LAT = "lat AS (SELECT ts, event_type, value / 100e0 AS seconds FROM events)"


@query(f"WITH {_LAT} SELECT event_type, {_SUMS}, count(*) AS n FROM lat GROUP BY 1")
def bucket_counts(spark, sf):
    return R.bucket_counts(_latency(spark, sf), "seconds", by=["event_type"])


def _quantile(q: float) -> str:
    low, below, whens = "0e0", "0", []
    for b in LATENCY_BOUNDS:
        c = R.bucket_name(b)
        whens.append(f"WHEN {c} >= {q}e0 * n THEN coalesce({low} + ({b}e0 - {low}) * (({q}e0 * n - {below}) / nullif({c} - {below}, 0)), {b}e0)")
        low, below = f"{b}e0", c
    return f"CASE {' '.join(whens)} ELSE {low} END"


_QUANTILES = ", ".join(f"floor({_quantile(q)} * 1e9 + 0.5e0) / 1e9 AS p{int(q * 100)}" for q in (0.5, 0.95, 0.99))


def _quantile_digits(df):
    return V.round_features(df, {"p50": 9, "p95": 9, "p99": 9})


@query(f"WITH {_LAT}, b AS (SELECT event_type, {_SUMS}, count(*) AS n FROM lat GROUP BY 1) SELECT event_type, n, {_QUANTILES} FROM b")
def histogram_quantile(spark, sf):
    return _quantile_digits(R.histogram_quantile(R.bucket_counts(_latency(spark, sf), "seconds", by=["event_type"])))


@query(f"""WITH {_LAT}, b AS (SELECT date_trunc('hour', ts) AS window_start, {_SUMS}, count(*) AS n FROM lat GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n, {_QUANTILES} FROM b""")
def histogram_quantile_windows(spark, sf):
    return _quantile_digits(R.histogram_quantile(R.window_buckets(_latency(spark, sf), "seconds", "1 hour")))


@query(f"""WITH {_LAT}, b AS (SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * i AS window_start, {_SUMS}, count(*) AS n
  FROM lat, range(3) t(i) GROUP BY 1)
SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end, n, {_QUANTILES} FROM b""")
def histogram_quantile_sliding(spark, sf):
    return _quantile_digits(R.histogram_quantile(R.window_buckets(_latency(spark, sf), "seconds", "3 hours", "1 hour")))


# --- streams ---------------------------------------------------------------------


def _event_stream(spark, sf):
    path = f"{sf}/events.parquet"
    return stream_table(spark, path, spark.read.parquet(path).schema)


def _ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(f"""WITH w AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
  count(*) AS n, count(*) / 3600e0 AS per_second, count(*) * 60e0 / 3600e0 AS per_minute FROM events GROUP BY 1, 2, 3)
SELECT * FROM w WHERE {_CLOSED}""")
def stream_rates(spark, sf):
    from annualis.streaming.jobs import run_to_table
    from annualis.streaming.jobs import stream_rates as rates

    out = scratch_path(spark, "stream-rates")
    run_to_table(rates(_event_stream(spark, sf), width="1 hour", by=["event_type"]), out, out + "-state")
    return _ntz(spark.read.parquet(out))


@query(f"""WITH m AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS slot, event_type FROM events),
e AS (SELECT min(slot) - INTERVAL 4 HOUR AS a, max(slot) AS b FROM m),
axis AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS s FROM e),
c AS (SELECT slot - INTERVAL 1 HOUR * i AS s, count(*) AS n FROM m, range(5) t(i) WHERE regexp_matches(event_type, '^err') GROUP BY 1),
w AS (SELECT axis.s AS window_start, axis.s + INTERVAL 5 HOUR AS window_end, coalesce(n, 0) AS n FROM axis LEFT JOIN c ON c.s = axis.s)
SELECT * FROM w WHERE {_CLOSED}""")
def stream_increase(spark, sf):
    from annualis.streaming import alerts

    out = scratch_path(spark, "stream-increase")
    alerts.run_increase(alerts.stream_increase(_event_stream(spark, sf), "event_type", "^err", 18_000, 3_600), out, out + "-state")
    return _ntz(spark.read.parquet(out))


@query(f"""WITH {_LAT}, b AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  {_SUMS}, count(*) AS n FROM lat GROUP BY 1, 2) SELECT window_start, window_end, n, {_QUANTILES} FROM b WHERE {_CLOSED}""")
def stream_quantiles(spark, sf):
    from annualis.streaming.jobs import run_to_table
    from annualis.streaming.jobs import stream_quantiles as quantiles

    out = scratch_path(spark, "stream-quantiles")
    latency = _event_stream(spark, sf).withColumn("seconds", F.col("value") / F.lit(100.0))
    run_to_table(quantiles(latency, "seconds", width="1 hour"), out, out + "-state")
    return _quantile_digits(_ntz(spark.read.parquet(out)))


@query(f"WITH {SCORED} SELECT event_id, parcel_id, predicted_yield, irrigation_rec_mm FROM scored")
def stream_score(spark, sf):
    from annualis.streaming.jobs import stream_score as run

    out = scratch_path(spark, "stream-score")
    requests = V.requests(spark, sf, _event_stream(spark, sf))
    run(requests, V.features(spark, sf), formula_model, out, out + "-state", MODEL_NAME, CONFIDENCE, digits=None)
    log = spark.read.parquet(out).select("event_id", "parcel_id", "predicted_yield", "irrigation_rec_mm")
    return V.round_features(log, {"predicted_yield": 3, "irrigation_rec_mm": 1})
