"""Queries of hard cases: NULL keys and values, large groups, restarts, name collisions; and checkable facts of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.operators import attribution as A
from annualis.operators import cleaning as C
from annualis.operators import joins as J
from annualis.operators import modelling as M
from annualis.operators import quantiles as Q
from annualis.operators import sketches as K
from annualis.operators import scoring as P
from annualis.operators import series as SE
from annualis.operators import stats as S
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.plans.q_joins import _CONFIG, SCORED, _score_sql, formula_model, matrix
from annualis.plans.q_stats import _INPUTS, _MEAN_ABS, _attributed, _rounded
from annualis.schemas import CONFIDENCE, FEATURES, MODEL_NAME, SERIES_INPUTS, TARGET
from annualis.session import scratch_path, stored
from annualis.sources import readers, sinks

# --- NULL keys: every tenth line has none ------------------------------------------

_LINES = """lines AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 0 THEN l_returnflag END AS flag,
  l_quantity AS q, l_extendedprice / 1000e0 AS v FROM lineitem)"""


def _lines(spark, sf):
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_returnflag")).alias("flag"),
        F.col("l_quantity").alias("q"), (F.col("l_extendedprice") / F.lit(1000.0)).alias("v"))


_NULL_QUANTILES = f"""WITH {_LINES}, long AS (SELECT flag, n, unnest([0.1e0, 0.5e0, 0.99e0]) AS q, unnest([a, b, c]) AS value FROM (
  SELECT flag, count(*) AS n, quantile_cont(v, 0.1) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.99) AS c FROM lines GROUP BY 1))
SELECT flag, q, {sql_round('value', 6)} AS value, n FROM long"""


@query(_NULL_QUANTILES)
def null_key_quantiles(spark, sf):
    return _rounded(Q.exact_quantiles(_lines(spark, sf), ["flag"], "v", [0.1, 0.5, 0.99]), 6, "value")


@query(_NULL_QUANTILES)
def null_key_quantiles_narrowed(spark, sf):
    """The same by narrowing: no group is small."""
    out = Q.exact_quantiles(_lines(spark, sf), ["flag"], "v", [0.1, 0.5, 0.99], cell_rows=200, bins=64)
    return _rounded(out, 6, "value")


_NULL_MINMAX = f"""WITH {_LINES} SELECT l_orderkey, l_linenumber,
  {sql_round('((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w))', 4)} AS value_normalized FROM lines WINDOW w AS (PARTITION BY flag)"""


@query(_NULL_MINMAX)
def null_key_minmax(spark, sf):
    out = SE.minmax(_lines(spark, sf), "flag", "v", digits=None)
    return _rounded(out.select("l_orderkey", "l_linenumber", "value_normalized"), 4, "value_normalized")


@query(_NULL_MINMAX)
def null_key_minmax_any_size(spark, sf):
    out = SE.minmax(_lines(spark, sf), "flag", "v", digits=None, any_size=True)
    return _rounded(out.select("l_orderkey", "l_linenumber", "value_normalized"), 4, "value_normalized")


@query(f"""WITH {_LINES} SELECT l_orderkey, l_linenumber, {sql_round('((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-9))', 6)} AS v_scaled
FROM lines WINDOW w AS (PARTITION BY flag)""")
def null_key_range_scale(spark, sf):
    return _rounded(S.range_scale(_lines(spark, sf), ["flag"], ["v"]).select("l_orderkey", "l_linenumber", "v_scaled"), 6, "v_scaled")


@query(f"""WITH {_LINES}, c AS (SELECT flag, avg(q) AS center, stddev_pop(q) AS scale, count(*) AS n FROM lines GROUP BY 1)
SELECT flag, {sql_round('center', 6)} AS center, {sql_round('scale', 6)} AS scale, n, true AS residuals_vanish FROM c""")
def null_key_quad_fit(spark, sf):
    """The fit by its conditions: residuals are orthogonal to 1, z and z squared."""
    lines = _lines(spark, sf)
    fit = stored(S.quad_fit(lines, "q", "v", ["flag"]), "fit")
    named = fit.withColumnRenamed("flag", "_flag")
    joined = lines.join(named, F.col("flag").eqNullSafe(F.col("_flag"))).drop("_flag")
    z = (F.col("q") - F.col("center")) / F.col("scale")
    r = F.col("v") - (F.col("c0") + z * (F.col("c1") + z * F.col("c2")))
    sums = joined.groupBy("flag", "center", "scale", "n").agg(*[(F.abs(F.sum(r * w)) < 1e-6 * F.col("n")).alias(f"s{k}") for k, w in enumerate((F.lit(1.0), z, z * z))])
    out = sums.select("flag", "center", "scale", "n", (F.col("s0") & F.col("s1") & F.col("s2")).alias("residuals_vanish"))
    return _rounded(out, 6, "center", "scale")


# --- large groups and sketches --------------------------------------------------------

_BOXES = "SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, count(*) AS n FROM events GROUP BY 1"


@query(f"SELECT event_type, {sql_round('q1', 6)} AS q1, {sql_round('median', 6)} AS median, {sql_round('q3', 6)} AS q3, n FROM ({_BOXES})")
def box_stats_narrowed(spark, sf):
    """Quartiles by the way of large groups."""
    long = Q.exact_quantiles(V.events(spark, sf), ["event_type"], "value", [0.25, 0.5, 0.75], cell_rows=20, bins=16)
    at = lambda q: F.max(F.when(F.col("q") == q, F.col("value")))
    out = long.groupBy("event_type").agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"), F.max("n").alias("n"))
    return _rounded(out, 6, "q1", "median", "q3")


@query("SELECT true AS equal, count(DISTINCT event_type) * 36 AS n FROM events")
def quantile_paths_agree(spark, sf):
    """36 quantiles a group with infinities among the values, bit for bit the same by sorting and by narrowing."""
    data = V.events(spark, sf).select("event_type", F.when(F.col("event_id") % 17 == 0, F.lit(float("inf")))
                                      .when(F.col("event_id") % 19 == 0, F.lit(float("-inf"))).otherwise(F.col("value") / 3).alias("v"))
    data, qs = stored(data, "values"), [k / 35 for k in range(36)]
    one = Q.exact_quantiles(data, ["event_type"], "v", qs)
    other = Q.exact_quantiles(data, ["event_type"], "v", qs, cell_rows=10, bins=8).withColumnRenamed("value", "other")
    both = one.join(other, ["event_type", "q", "n"])
    return both.agg(F.every(F.col("value").eqNullSafe(F.col("other"))).alias("equal"), F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT event_type, unnest([0.25e0, 0.5e0, 0.75e0]) AS q, true AS within FROM events")
def approx_quantile_error(spark, sf):
    """The sketch's ranks are within n / accuracy of the wanted ones."""
    ev = V.events(spark, sf).select("event_type", F.col("value").alias("v"))
    found = stored(Q.approx_quantiles(ev, ["event_type"], "v", [0.25, 0.5, 0.75], 1_000), "sketch")
    share = lambda c: F.avg(c.cast("double"))
    ranks = ev.join(found, "event_type").groupBy("event_type", "q").agg(
        share(F.col("v") < F.col("value")).alias("low"), share(F.col("v") <= F.col("value")).alias("high"), F.first("n").alias("n"))
    slack = F.lit(0.001) + F.lit(1.0) / F.col("n")
    return ranks.select("event_type", "q", ((F.col("low") <= F.col("q") + slack) & (F.col("high") >= F.col("q") - slack)).alias("within"))


def _day_sketches(spark, sf):
    """Sketches of event values by type and day, of which some days are loaded once more."""
    path = scratch_path(spark, "sketches")
    ev = V.events(spark, sf).select("event_type", F.dayofmonth("ts").alias("day"), F.col("value").alias("v"))
    K.store_sketches(ev, path, ["event_type"], "day", "v")
    K.store_sketches(ev.filter("day in (9, 10, 11)"), path, ["event_type"], "day", "v")
    return K.merged(spark, path, ["event_type"], "day", 10, 20), ev.filter("day between 10 and 20")


@query("""SELECT event_type, unnest([0.01e0, 0.25e0, 0.5e0, 0.75e0, 0.99e0]) AS q, n, true AS within FROM (
  SELECT event_type, count(*) AS n FROM events WHERE day(ts) BETWEEN 10 AND 20 GROUP BY 1)""")
def stored_sketch_quantiles(spark, sf):
    """Quantiles of eleven days from stored sketches alone; their ranks among those days' rows are close to the wanted ones."""
    sketches, rows = _day_sketches(spark, sf)
    found = stored(K.sketch_quantiles(sketches, ["event_type"], [0.01, 0.25, 0.5, 0.75, 0.99]), "of-sketches")
    share = lambda c: F.avg(c.cast("double"))
    ranks = rows.join(found, "event_type").groupBy("event_type", "q", "n").agg(
        share(F.col("v") < F.col("value")).alias("low"), share(F.col("v") <= F.col("value")).alias("high"))
    slack = F.lit(2 * K.rank_error()) + F.lit(1.0) / F.col("n")
    return ranks.select("event_type", "q", "n", ((F.col("low") <= F.col("q") + slack) & (F.col("high") >= F.col("q") - slack)).alias("within"))


@query("""SELECT event_type, count(*) AS n, true AS quartiles, true AS outliers FROM events WHERE day(ts) BETWEEN 10 AND 20 GROUP BY 1""")
def stored_sketch_boxes(spark, sf):
    """Box plots from stored sketches: ranks of the quartiles and the number of outliers against the rows."""
    sketches, rows = _day_sketches(spark, sf)
    boxes = stored(K.sketch_boxes(sketches, ["event_type"]), "boxes")
    v = F.col("v")
    within = [F.count_if(v < F.col(c)).alias(f"_{c}_low") for c in ("q1", "median", "q3")]
    within += [F.count_if(v <= F.col(c)).alias(f"_{c}_high") for c in ("q1", "median", "q3")]
    outside = F.count_if((v < F.col("fence_low")) | (v > F.col("fence_high"))).alias("_outside")
    seen = rows.join(boxes, "event_type").groupBy("event_type", "n", F.col("outliers").alias("_guess")).agg(*within, outside)
    slack = F.lit(2 * K.rank_error()) * F.col("n") + 1
    ok = F.lit(True)
    for c, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        ok = ok & (F.col(f"_{c}_low") <= q * F.col("n") + slack) & (F.col(f"_{c}_high") >= q * F.col("n") - slack)
    close = F.abs(F.col("_outside") - F.col("_guess")) <= 2 * slack
    return seen.select("event_type", "n", ok.alias("quartiles"), close.alias("outliers"))


@query("SELECT CAST(199 AS BIGINT) AS points, true AS within, true AS rising FROM (SELECT count(*) FROM lineitem)")
def qq_grid_error(spark, sf):
    """Every twentieth point's rank is within n / accuracy of the wanted one, and the points rise."""
    rows = V.predicted_orders(spark, sf).select("residual")
    grid = [r["ordered"] for r in Q.qq_grid(rows, "residual").orderBy("theoretical").collect()]  # 199 numbers
    share = lambda test: F.avg(test.cast("double"))
    x = F.col("residual")
    ok = F.lit(True)
    for k, at in list(enumerate(grid))[9::20]:
        ok = ok & (share(x < at) <= (k + 1) / 200 + 2e-4) & (share(x <= at) >= (k + 1) / 200 - 2e-4)
    return rows.agg(F.lit(len(grid)).cast("long").alias("points"), ok.alias("within"), F.lit(grid == sorted(grid)).alias("rising"))


# --- mended cases ----------------------------------------------------------------------


@query(f"""WITH {V.PREDICTED}, h AS (SELECT l_returnflag, y, CASE WHEN l_orderkey % 7 <> 0 THEN yhat END AS yhat FROM predicted),
k AS (SELECT *, y - yhat AS r FROM h WHERE yhat IS NOT NULL)
SELECT l_returnflag, {sql_round('sqrt(avg(r * r))', 6)} AS rmse, {sql_round('avg(abs(r))', 6)} AS mae,
  {sql_round('(1e0 - sum(r * r) / (var_pop(y) * count(*)))', 6)} AS r2, {sql_round('avg(r)', 6)} AS bias, count(*) AS n FROM k GROUP BY 1""")
def metrics_with_nulls(spark, sf):
    rows = V.predicted_orders(spark, sf).withColumn("yhat", F.when(F.col("l_orderkey") % 7 != 0, F.col("yhat")))
    out = S.regression_metrics(rows, "y", "yhat", ["l_returnflag"]).drop("sigma")
    return _rounded(out, 6, "rmse", "mae", "r2", "bias")


@query(f"WITH {V.SERIES} SELECT area || ' X' AS area, year || '-01-01' AS ds, value_tonnes AS yhat FROM series")
def forecast_lookup(spark, sf):
    """Each entity asked for by name, where another one shares its folder."""
    series = V.stored_series(spark, sf)
    rows = lambda tail: series.select(F.concat("area", F.lit(tail)).alias("area"), F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("ds"),
                                      F.col("value_tonnes").alias("yhat"), F.lit(0.0).alias("yhat_lower"), F.lit(0.0).alias("yhat_upper"))
    path = scratch_path(spark, "forecast")
    sinks.write_forecast_json(rows(" X").unionByName(rows("/X").withColumn("yhat", F.lit(-1.0))), path)
    names = [r["n_name"] for r in V.table(spark, sf, "nation").select("n_name").orderBy("n_name").collect()]  # 25 rows
    out = readers.read_forecast(spark, path, f"{names[0]} X")
    for name in names[1:]:
        out = out.unionByName(readers.read_forecast(spark, path, f"{name} X"))
    return out.select("area", "ds", "yhat")


@query(f"""WITH {V.FEATURES_CTE}, {V.PARCELS}, {V.REQUESTS} SELECT event_id, coalesce(f.value_tonnes, 0e0) AS value_tonnes,
  coalesce(f.yoy_growth_pct, 0e0) AS yoy_growth_pct, coalesce(f.ma5_tonnes, 0e0) AS ma5_tonnes, coalesce(f.value_normalized, 0e0) AS value_normalized
FROM requests r LEFT JOIN features f ON f.area = r.country AND f.year = r.year""")
def enrich_null_duplicates(spark, sf):
    """A key's row without a value doesn't win over the one with a value."""
    known = V.features(spark, sf)
    hollow = known.withColumns({c: F.lit(None).cast("double") for c in SERIES_INPUTS})
    return J.enrich_requests(V.requests(spark, sf), known.unionByName(hollow)).select("event_id", *SERIES_INPUTS)


@query(f"WITH {SCORED} SELECT event_id, predicted_yield FROM scored UNION ALL SELECT event_id, predicted_yield FROM scored")
def stream_score_restarted(spark, sf):
    """The stream is run again with a new checkpoint on the same log: both runs are kept."""
    from annualis.plans.q_rates import _event_stream
    from annualis.streaming.jobs import stream_score as run

    out, features = scratch_path(spark, "stream-log"), V.features(spark, sf)
    for k in range(2):
        run(V.requests(spark, sf, _event_stream(spark, sf)), features, formula_model, out, f"{out}-state{k}", MODEL_NAME, CONFIDENCE, digits=None)
    return V.round_features(spark.read.parquet(out).select("event_id", "predicted_yield"), {"predicted_yield": 3})


# --- single lookups and selections ---------------------------------------------------------


@query(f"WITH {V.PARCELS} SELECT id, name, crop_type, country FROM parcels WHERE id = (SELECT max(c_custkey) FROM customer)")
def parcel_by_id(spark, sf):
    last = V.table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0]
    return C.by_id(V.parcels(spark, sf), last).select("id", "name", "crop_type", "country")


@query(f"""WITH {V.FEATURES_CTE} SELECT value_tonnes, yoy_growth_pct, ma5_tonnes, value_normalized FROM features
WHERE area = (SELECT max(n_name) FROM nation) AND year = 1997""")
def features_of_entity(spark, sf):
    name = V.table(spark, sf, "nation").agg(F.max("n_name")).first()[0]
    return C.lookup_features(V.features(spark, sf), name, 1997)


@query("SELECT o_totalprice, o_orderkey FROM orders")
def selected_columns(spark, sf):
    """Of the wanted columns those that exist, in the wanted order."""
    return C.select_existing(V.table(spark, sf, "orders"), ["o_totalprice", "no_such_column", "o_orderkey"])


@query(f"""WITH {V.PARCELS}, {V.PREDICTION_LOG} SELECT l.id, parcel_id, predicted_at FROM prediction_log l JOIN parcels p ON p.id = l.parcel_id
ORDER BY predicted_at DESC, l.id DESC LIMIT 25""")
def history_limited(spark, sf):
    """The latest rows up to a checked limit; a limit beyond the bound is refused."""
    try:
        C.check_limit(501)
    except ValueError:
        return J.prediction_history(V.prediction_log(spark, sf), V.parcels(spark, sf), C.check_limit(25)).select("id", "parcel_id", "predicted_at")
    raise AssertionError("a limit of 501 passed")


@query("SELECT CAST(coalesce(sum(event_id), 0) AS BIGINT) AS total FROM events WHERE event_type <> 'outage'")
def total_of_events(spark, sf):
    return S.total_or_zero(V.events(spark, sf).filter(F.col("event_type") != "outage"), "event_id")


@query(f"""WITH {_MEAN_ABS}, m AS (SELECT feature, avg(v) AS importance FROM long GROUP BY 1)
SELECT feature, {sql_round('importance', 6)} AS importance FROM m ORDER BY m.importance DESC, feature LIMIT 3""")
def top_importances(spark, sf):
    rows, coef = _attributed(spark, sf)
    table = A.mean_abs_attributions(rows, _INPUTS, coef).select("feature", F.col("mean_abs").alias("importance"))
    return _rounded(M.top_importances(table, 3), 6, "importance")


@query(f"""WITH {_MEAN_ABS}, top AS (SELECT feature FROM (SELECT feature, avg(v) AS a FROM long GROUP BY 1) ORDER BY a DESC, feature LIMIT 4),
s AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, min(b_{c}) * stddev_pop({c}) AS slope, avg({c}) AS center, count(*) AS n FROM matrix, coef" for c in _INPUTS)})
SELECT feature, {sql_round('slope', 6)} AS slope, {sql_round('center', 6)} AS center, n, true AS straight FROM s WHERE feature IN (SELECT feature FROM top)""")
def attribution_trend(spark, sf):
    """Quadratic fit of contribution on feature value for the strongest features; a linear model's are straight lines."""
    rows, coef = _attributed(spark, sf)
    fit = A.attribution_trend(rows, _INPUTS, coef, 4)
    straight = (F.abs("c0") < 1e-6) & (F.abs("c2") < 1e-6)
    return _rounded(fit.select("feature", F.col("c1").alias("slope"), "center", "n", straight.alias("straight")), 6, "slope", "center")


# --- hashed randomness and models --------------------------------------------------------------


def _hash_sql(seed: int, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || {key}), 1, 15) AS BIGINT)"


def _uniform_sql(seed: int, key: str) -> str:
    return f"((CAST({_hash_sql(seed, key)} >> 8 AS DOUBLE) + 0.5e0) / 4503599627370496e0)"


@query(f"WITH {V.MATRIX} SELECT reading_id, {_hash_sql(42, 'reading_id')} % 1000000 < 200000 AS is_test, {_hash_sql(7, 'reading_id')} % 5 + 1 AS fold FROM matrix")
def split_and_folds(spark, sf):
    marked = M.with_fold(M.split_random(matrix(spark, sf), ["reading_id"]), ["reading_id"], 5, 7)
    return marked.select("reading_id", "is_test", "fold")


_NOISE = f"(0.12e0 * base * sqrt(-2e0 * ln({_uniform_sql(42, 'r.id')})) * cos(6.283185307179586e0 * {_uniform_sql(43, 'r.id')}))"
_NOISY = _score_sql("coalesce(f.value_normalized, 0.3e0)").replace(" + 0.05e0)", f" + 0.05e0) + {_NOISE}")


@query(f"""WITH {V.FEATURES_CTE}, {V.PARCELS}, {V.READINGS}, {_CONFIG}
SELECT r.id, {_NOISY} AS score
FROM readings r JOIN parcels p ON p.id = r.parcel_id JOIN config ON crop = crop_type
LEFT JOIN features f ON f.area = p.country AND f.year = year(r.recorded_at)""")
def noisy_response(spark, sf):
    """The response with the series looked up and hashed noise."""
    entity = V.parcels(spark, sf).select(F.col("id").alias("parcel_id"), "crop_type", "country")
    sensed = V.readings(spark, sf).withColumn("year", F.year("recorded_at")).join(entity, "parcel_id")
    scored = P.response_score(J.intensity_lookup(sensed, V.features(spark, sf)), digits=None, noise_seed=42, noise_key="id")
    return V.round_features(scored.select("id", "score"), {"score": 3})


@query(f"WITH {V.MATRIX} SELECT count(*) AS n, true AS orthogonal FROM matrix")
def linear_model_residuals(spark, sf):
    """A fitted linear model's residuals are orthogonal to every input."""
    rows = stored(matrix(spark, sf, ("reading_id",)), "matrix")
    out = M.fit_linear(rows).transform(M.assemble(rows))
    r = F.col(TARGET) - F.col("prediction")
    free = F.lit(True)
    for c in FEATURES:
        free = free & (F.coalesce(F.abs(F.corr(F.col(c).cast("double"), r)), F.lit(0.0)) < 1e-4)
    return out.agg(F.count(F.lit(1)).alias("n"), (free & (F.abs(F.avg(r)) < 1e-6)).alias("orthogonal"))


@query(f"WITH {V.SERIES} SELECT area, true AS converged, count(*) AS n FROM series GROUP BY 1")
def piecewise_holdout(spark, sf):
    """Hold-out score of the trend that forecasts: it is finite, and every fit converged."""
    from annualis.operators import forecast as FC

    series = V.stored_series(spark, sf)
    fits = FC.piecewise_fit(series, cutoff=1996)
    scores = FC.piecewise_holdout(series, cutoff=1996)
    counts = series.groupBy("area").agg(F.count(F.lit(1)).alias("n"))
    out = counts.join(fits.select("area", "converged"), "area").join(scores, "area")
    return out.select("area", (F.col("converged") & F.col("mape").isNotNull() & (F.col("mape") >= 0)).alias("converged"), "n")


_FOLD_SPREAD = f"""WITH {V.PREDICTED}, f AS (SELECT l_orderkey % 5 AS fold, 1e0 - sum(residual * residual) / (var_pop(y) * count(*)) AS r2 FROM predicted GROUP BY 1)
SELECT CASE WHEN stddev_pop(r2) < 0.01e0 THEN 'good' ELSE 'warn' END AS r2_std_flag FROM f"""


@query(_FOLD_SPREAD)
def fold_spread_flag(spark, sf):
    """The gate on the spread of R2 over folds."""
    from annualis.operators.quality import quality_flags

    rows = V.predicted_orders(spark, sf).withColumn("fold", F.col("l_orderkey") % 5)
    folds = S.fold_summary(S.regression_metrics(rows, "y", "yhat", ["fold"]), ["r2"], 0)
    return quality_flags(folds).select("r2_std_flag")
