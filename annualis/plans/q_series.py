"""Queries of the series family."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.operators import series as S
from annualis.operators import stats
from annualis.operators import joins as J
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.session import stored

_F = V.feature_exprs()


def _year(df):
    return df.withColumn("year", F.col("year").cast("bigint"))


def _feature_sql(source_cte: str, source: str, columns: list[str]) -> str:
    picked = ", ".join(f"{_F[c]} AS {c}" for c in columns)
    return (f"WITH {source_cte}, {V.wide_cte(source)} SELECT area, CAST(year AS BIGINT) AS year, value_tonnes, {picked} "
            "FROM wide")


@query(_feature_sql(V.SERIES, "series", list(_F)))
def series_features(spark, sf):
    return _year(V.round_features(S.series_features(V.stored_series(spark, sf), rounding=False)))


@query(_feature_sql(V.CUSTOMER_SERIES, "customer_series", list(_F)))
def series_features_gaps(spark, sf):
    raw = stored(V.customer_series(spark, sf), "series")
    return _year(V.round_features(S.series_features(raw, rounding=False)))


@query(_feature_sql(V.SERIES, "series", ["yoy_growth_pct"]))
def series_yoy(spark, sf):
    return _year(V.round_features(S.growth(V.series(spark, sf), digits=None)))


@query(_feature_sql(V.SERIES, "series", ["ma5_tonnes"]))
def series_ma5(spark, sf):
    return _year(V.round_features(S.moving_avg(V.series(spark, sf), digits=None)))


@query(_feature_sql(V.SERIES, "series", ["cagr_5y_pct"]))
def series_cagr(spark, sf):
    return _year(V.round_features(S.cagr(V.series(spark, sf), digits=None)))


@query(_feature_sql(V.SERIES, "series", ["value_normalized"]))
def series_minmax(spark, sf):
    return _year(V.round_features(S.minmax(V.series(spark, sf), digits=None)))


@query(_feature_sql(V.SERIES, "series", ["pct_vs_global_avg"]))
def series_vs_avg(spark, sf):
    return _year(V.round_features(S.vs_period_avg(V.stored_series(spark, sf), digits=None)))


_EV = """e AS (SELECT event_type AS area, event_id, ts, CAST(floor(value * 100e0 + 0.5e0) AS DOUBLE) AS v,
  1 AS period FROM events)"""
_LONG = V.feature_exprs("v")


@query(f"""WITH {_EV}, {V.wide_cte('e', 'area', 'ts, event_id', 'v', 'period')}
SELECT area, event_id, v, {_LONG['yoy_growth_pct']} AS growth_pct, {_LONG['ma5_tonnes']} AS ma5,
  {_LONG['cagr_5y_pct']} AS cagr_5_pct, {_LONG['value_normalized']} AS normalized FROM wide""")
def long_series_features(spark, sf):
    ev = V.events(spark, sf).select(
        F.col("event_type").alias("area"), "event_id", "ts", V.cents("value").cast("double").alias("v"))
    out = S.long_series_features(ev, "area", ["ts", "event_id"], "v", rounding=False)
    digits = {"growth_pct": 2, "ma5": 2, "cagr_5_pct": 2, "normalized": 4}
    return V.round_features(out, digits).select("area", "event_id", "v", *digits)


@query(f"""WITH {V.CUSTOMER_SERIES}
SELECT s.area, CAST(s.year AS BIGINT) AS year, s.value_tonnes,
  {sql_round('(CASE WHEN p.value_tonnes <> 0 THEN (s.value_tonnes - p.value_tonnes) / p.value_tonnes * 100e0 END)', 2)} AS yoy_growth_pct,
  {sql_round('avg(s.value_tonnes) OVER (PARTITION BY s.area ORDER BY s.year RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)', 2)} AS ma5_tonnes,
  {sql_round('(CASE WHEN b.value_tonnes > 0 THEN (pow(s.value_tonnes / b.value_tonnes, 0.2e0) - 1e0) * 100e0 END)', 2)} AS cagr_5y_pct
FROM customer_series s LEFT JOIN customer_series p ON p.area = s.area AND p.year = s.year - 1
LEFT JOIN customer_series b ON b.area = s.area AND b.year = s.year - 5""")
def series_calendar(spark, sf):
    return _year(V.round_features(S.calendar_features(V.customer_series(spark, sf), rounding=False)))


@query(f"""WITH e AS (SELECT event_type AS area, event_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) // 3600 AS hour,
  CAST(floor(value * 100e0 + 0.5e0) AS DOUBLE) AS v FROM events),
w AS (SELECT *, max(v) OVER (PARTITION BY area ORDER BY hour RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev,
  max(v) OVER (PARTITION BY area ORDER BY hour RANGE BETWEEN 5 PRECEDING AND 5 PRECEDING) AS base,
  avg(v) OVER (PARTITION BY area ORDER BY hour RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean FROM e)
SELECT area, event_id, hour, v, {sql_round('(CASE WHEN prev <> 0 THEN (v - prev) / prev * 100e0 END)', 2)} AS yoy_growth_pct,
  {sql_round('mean', 2)} AS ma5_tonnes,
  {sql_round('(CASE WHEN base > 0 THEN (pow(v / base, 0.2e0) - 1e0) * 100e0 END)', 2)} AS cagr_5y_pct FROM w""")
def long_calendar(spark, sf):
    """Features by the hour over events, many to an hour; blocks of 100 hours."""
    hour = (F.unix_seconds(F.date_trunc("hour", "ts")) / 3600).cast("bigint")
    ev = V.events(spark, sf).select(F.col("event_type").alias("area"), "event_id", hour.alias("hour"), V.cents("value").cast("double").alias("v"))
    return V.round_features(S.long_calendar_features(ev, "area", "hour", "v", rounding=False, span=100))


@query(f"""WITH {V.CUSTOMER_SERIES}, ends AS (SELECT area, min(year) AS a, max(year) AS b FROM customer_series GROUP BY 1),
axis AS (SELECT area, CAST(unnest(range(a, b + 1)) AS BIGINT) AS year FROM ends)
SELECT axis.area, axis.year, value_tonnes FROM axis LEFT JOIN customer_series c ON c.area = axis.area AND c.year = axis.year""")
def series_densify(spark, sf):
    return _year(S.densify(stored(V.customer_series(spark, sf), "series")))


@query(f"""WITH {V.FEATURES_CTE} SELECT area, CAST(year AS BIGINT) AS year, value_tonnes, yoy_growth_pct, ma5_tonnes,
  cagr_5y_pct, value_normalized, pct_vs_global_avg FROM features ORDER BY area, year""")
def series_history(spark, sf):
    return S.history(_year(V.features(spark, sf)))


@query(f"""WITH {V.FEATURES_CTE}, peak AS (SELECT area, max(value_tonnes) AS peak FROM features GROUP BY 1)
SELECT f.area, sum(value_tonnes) AS total, max(value_tonnes) AS peak,
  CAST(min(CASE WHEN value_tonnes = peak THEN year END) AS BIGINT) AS peak_period,
  max_by(value_tonnes, year) AS last_value, CAST(max(year) AS BIGINT) AS last_period,
  max_by(yoy_growth_pct, year) FILTER (yoy_growth_pct IS NOT NULL) AS last_growth
FROM features f JOIN peak ON peak.area = f.area GROUP BY f.area""")
def series_stats(spark, sf):
    return S.series_stats(_year(V.features(spark, sf)))


@query(f"""WITH {V.FEATURES_CTE} SELECT area, CAST(year AS BIGINT) AS year, yoy_growth_pct FROM features
WHERE yoy_growth_pct IS NOT NULL""")
def series_growth_known(spark, sf):
    from annualis.operators.cleaning import not_null

    return not_null(_year(V.features(spark, sf)).select("area", "year", "yoy_growth_pct"), "yoy_growth_pct")


@query(f"WITH {V.SERIES} SELECT DISTINCT area FROM series ORDER BY area")
def series_entities(spark, sf):
    return S.entities(V.series(spark, sf))


@query(f"WITH {V.SERIES} SELECT area, sum(value_tonnes) AS total FROM series GROUP BY area")
def series_total(spark, sf):
    return S.total_by(V.series(spark, sf), "area", "value_tonnes")


@query(f"""WITH {V.SERIES}, best AS (SELECT area FROM series GROUP BY area ORDER BY sum(value_tonnes) DESC, area LIMIT 10)
SELECT area, CAST(year AS BIGINT) AS year, value_tonnes FROM series WHERE area IN (SELECT area FROM best)""")
def series_top(spark, sf):
    return _year(S.top_entities(V.stored_series(spark, sf), 10))


@query(f"""WITH {V.CUSTOMER_SERIES}, last AS (SELECT area, max(year) AS y FROM customer_series GROUP BY 1)
SELECT area, CAST(y + unnest(range(1, 6)) AS BIGINT) AS year FROM last""")
def future_spine(spark, sf):
    return _year(S.future_spine(V.customer_series(spark, sf)))


@query("SELECT c_custkey AS id, CAST(unnest(range(1995, 2002)) AS BIGINT) AS year, i AS copy FROM customer, range(1, 4) t(i)")
def spine(spark, sf):
    customers = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    out = J.spine(customers, 1995, 2001, copies=3, copy_name="copy")
    return out.select("id", F.col("year").cast("bigint").alias("year"), F.col("copy").cast("bigint").alias("copy"))


@query(f"WITH {V.FEATURES_CTE} SELECT area, max_by(cagr_5y_pct, year) FILTER (cagr_5y_pct IS NOT NULL) AS last_value "
       "FROM features GROUP BY 1")
def last_not_null(spark, sf):
    return S.last_not_null(V.features(spark, sf), "year", "cagr_5y_pct", ["area"])


# --- forecasts ---------------------------------------------------------------

_TREND = f"""{V.SERIES}, scaled AS (SELECT area, year, value_tonnes / 1e8 AS v FROM series),
fit AS (SELECT area, regr_slope(v, CAST(year AS DOUBLE)) AS slope, regr_avgx(v, CAST(year AS DOUBLE)) AS mid_x,
  regr_avgy(v, CAST(year AS DOUBLE)) AS mid_y, regr_sxx(v, CAST(year AS DOUBLE)) AS sxx,
  regr_syy(v, CAST(year AS DOUBLE)) AS syy, regr_sxy(v, CAST(year AS DOUBLE)) AS sxy, count(*) AS n
  FROM scaled WHERE year <= 1999 GROUP BY 1),
line AS (SELECT *, CASE WHEN n >= 3 AND sxx > 0 THEN sqrt(greatest(syy - sxy * sxy / sxx, 0e0) / (n - 2)) END AS s FROM fit),
last AS (SELECT area, max(year) AS y FROM series GROUP BY 1),
ahead AS (SELECT area, y + i AS year FROM last, range(1, 6) t(i)),
forecast AS (SELECT a.area, a.year, mid_y + slope * (a.year - mid_x) AS yhat,
  1.959963984540054e0 * s * sqrt(1e0 + 1e0 / n + (a.year - mid_x) * (a.year - mid_x) / sxx) AS half
  FROM ahead a JOIN line ON line.area = a.area)"""


def _scaled(spark, sf):
    return V.stored_series(spark, sf).withColumn("value_tonnes", F.col("value_tonnes") / F.lit(1e8))


@query(f"""WITH {_TREND} SELECT area, CAST(year AS BIGINT) AS year, strftime(make_date(year, 1, 1), '%Y-%m-%d') AS ds,
  {sql_round('greatest(yhat, 0e0)', 6)} AS yhat, {sql_round('(yhat - half)', 6)} AS yhat_lower,
  {sql_round('(yhat + half)', 6)} AS yhat_upper FROM forecast""")
def forecast_trend(spark, sf):
    from annualis.operators.forecast import forecast_trend as run

    out = run(_scaled(spark, sf), cutoff=1999, digits=None)
    return _year(V.round_features(out, {"yhat": 6, "yhat_lower": 6, "yhat_upper": 6}))


@query(f"""WITH {_TREND} SELECT t.area,
  {sql_round('(avg(CASE WHEN v <> 0 THEN abs((v - (mid_y + slope * (t.year - mid_x))) / v) END) * 100e0)', 6)} AS mape
FROM scaled t JOIN line ON line.area = t.area WHERE t.year > 1999 GROUP BY 1""")
def forecast_holdout(spark, sf):
    from annualis.operators.forecast import forecast_holdout as run

    return V.round_features(run(_scaled(spark, sf), cutoff=1999, digits=None), {"mape": 6})


@query(f"""WITH {_TREND}, scores AS (SELECT t.area,
  avg(CASE WHEN v <> 0 THEN abs((v - (mid_y + slope * (t.year - mid_x))) / v) END) * 100e0 AS mape
FROM scaled t JOIN line ON line.area = t.area WHERE t.year > 1999 GROUP BY 1)
SELECT {sql_round('avg(mape)', 6)} AS avg_mape FROM scores""")
def forecast_mean_mape(spark, sf):
    from annualis.operators.forecast import forecast_holdout as run

    scores = run(_scaled(spark, sf), cutoff=1999, digits=None)
    return V.round_features(stats.mean_mape(scores, None), {"avg_mape": 6})


@query(f"""WITH {_TREND}, best AS (SELECT area FROM scaled GROUP BY area ORDER BY sum(v) DESC, area LIMIT 10)
SELECT f.area, CAST(year AS BIGINT) AS year, {sql_round('greatest(yhat, 0e0)', 6)} AS yhat FROM forecast f
WHERE area IN (SELECT area FROM best)""")
def forecast_top(spark, sf):
    from annualis.operators.forecast import forecast_trend as run

    out = run(S.top_entities(_scaled(spark, sf), 10), cutoff=1999, digits=None)
    return _year(V.round_features(out, {"yhat": 6})).select("area", "year", "yhat")


@query(f"""WITH {_TREND}
SELECT area, make_date(year, 1, 1) AS ds, 'history' AS kind, {sql_round('v', 6)} AS value,
  CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper FROM scaled
UNION ALL SELECT area, make_date(year, 1, 1), 'forecast', {sql_round('greatest(yhat, 0e0)', 6)},
  {sql_round('(yhat - half)', 6)}, {sql_round('(yhat + half)', 6)} FROM forecast""")
def overlay(spark, sf):
    from annualis.operators.forecast import forecast_trend as run

    past = _scaled(spark, sf)
    both = J.overlay(past, run(past, cutoff=1999, digits=None))
    return V.round_features(both, {"value": 6, "lower": 6, "upper": 6})


@query(f"""WITH {_TREND}, listed AS (SELECT DISTINCT area FROM scaled ORDER BY area LIMIT 6)
SELECT area, make_date(year, 1, 1) AS ds, 'history' AS kind, {sql_round('v', 6)} AS value FROM scaled WHERE area IN (SELECT area FROM listed)
UNION ALL SELECT area, make_date(year, 1, 1), 'forecast', {sql_round('greatest(yhat, 0e0)', 6)} FROM forecast
WHERE area IN (SELECT area FROM listed)""")
def overlay_first(spark, sf):
    """The first six entities in list order, the selection of a report page."""
    from annualis.operators.forecast import forecast_trend as run

    past = S.first_entities(_scaled(spark, sf), 6)
    both = J.overlay(past, run(past, cutoff=1999, digits=None))
    return V.round_features(both, {"value": 6}).select("area", "ds", "kind", "value")


@query()
def forecast_piecewise(spark, sf):
    from annualis.operators.forecast import forecast_piecewise as run

    return run(V.stored_series(spark, sf), cutoff=1999)


@query(f"""WITH {V.SERIES}
SELECT area, CAST(year AS BIGINT) AS year, value_tonnes, year > 1999 AS is_test FROM series""")
def split_by_time(spark, sf):
    from annualis.operators.cleaning import split_by_time as split

    train, test = split(V.stored_series(spark, sf), "year", 1999)
    return _year(train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))))


