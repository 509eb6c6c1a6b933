"""Queries of descriptive statistics, error metrics, fits and attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.functions import scalar as X
from annualis.operators import attribution as A
from annualis.operators import quantiles as Q
from annualis.operators import stats as S
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.plans.q_joins import matrix, training
from annualis.schemas import CROP_CLASSES, FEATURE_LABELS, FEATURES, TARGET
from annualis.session import stored


def _rounded(df, digits, *columns):
    return V.round_features(df, {c: digits for c in columns})


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(spark, sf):
    return S.value_counts(V.table(spark, sf, "customer"), "c_mktsegment")


@query(f"""WITH {V.PARCELS}, {V.PREDICTION_LOG} SELECT country, {sql_round('avg(predicted_yield)', 6)} AS mean
FROM prediction_log l JOIN parcels p ON p.id = parcel_id GROUP BY 1""")
def mean_by(spark, sf):
    entity = V.parcels(spark, sf).select(F.col("id").alias("parcel_id"), "country")
    joined = V.prediction_log(spark, sf).select("parcel_id", "predicted_yield").join(entity, "parcel_id")
    return _rounded(S.mean_by(joined, "country", "predicted_yield"), 6, "mean")


@query(f"""WITH {V.TRAINING} SELECT crop_type, {sql_round('avg(yield_t_per_ha)', 6)} AS mean,
  {sql_round('stddev_samp(yield_t_per_ha)', 6)} AS std FROM training GROUP BY 1""")
def mean_std(spark, sf):
    return _rounded(S.mean_std_by(training(spark, sf), "crop_type", TARGET), 6, "mean", "std")


@query(f"""WITH {V.TRAINING}, m AS (SELECT country, avg(yield_t_per_ha) AS mean FROM training GROUP BY 1)
SELECT country, {sql_round('mean', 6)} AS mean FROM m ORDER BY m.mean DESC, country LIMIT 8""")
def top_mean(spark, sf):
    return _rounded(S.top_mean(training(spark, sf), "country", TARGET, 8), 6, "mean")


@query(f"""WITH {V.TRAINING} SELECT CAST(year AS BIGINT) AS year, {', '.join(
    sql_round(f"avg(CASE WHEN crop_type = '{c}' THEN yield_t_per_ha END)", 6) + f" AS {c}" for c in CROP_CLASSES)}
FROM training GROUP BY 1""")
def pivot_mean(spark, sf):
    out = S.pivot_mean(training(spark, sf), "year", "crop_type", CROP_CLASSES, TARGET)
    return _rounded(out.withColumn("year", F.col("year").cast("bigint")), 6, *CROP_CLASSES)


@query(f"WITH {V.PREDICTED} SELECT * FROM predicted")
def residuals(spark, sf):
    return S.residuals(V.predicted_orders(spark, sf).drop("residual"), "y", "yhat")


@query(f"""WITH {V.PREDICTED} SELECT l_returnflag, year, {sql_round('avg(residual)', 6)} AS bias FROM predicted GROUP BY 1, 2""")
def residual_bias(spark, sf):
    return _rounded(S.residual_bias(V.predicted_orders(spark, sf), ["l_returnflag", "year"]), 6, "bias")


_METRICS = ", ".join(f"{sql_round(e, 6)} AS {n}" for n, e in {
    "rmse": "sqrt(avg((y - yhat) * (y - yhat)))", "mae": "avg(abs(y - yhat))",
    "r2": "(1e0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)))", "bias": "avg(y - yhat)",
    "sigma": "stddev_pop(y - yhat)"}.items())


@query(f"WITH {V.PREDICTED} SELECT {_METRICS}, count(*) AS n FROM predicted")
def regression_metrics(spark, sf):
    return _rounded(S.regression_metrics(V.predicted_orders(spark, sf), "y", "yhat"), 6, "rmse", "mae", "r2", "bias", "sigma")


def _folds(spark, sf):
    return V.predicted_orders(spark, sf).withColumn("fold", F.col("l_orderkey") % 5 + 1)


@query(f"WITH {V.PREDICTED} SELECT l_orderkey % 5 + 1 AS fold, {_METRICS}, count(*) AS n FROM predicted GROUP BY 1")
def fold_metrics(spark, sf):
    return _rounded(S.regression_metrics(_folds(spark, sf), "y", "yhat", ["fold"]), 6, "rmse", "mae", "r2", "bias", "sigma")


_FOLD_CTE = f"""{V.PREDICTED}, folds AS (SELECT l_orderkey % 5 + 1 AS fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  1e0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2 FROM predicted GROUP BY 1)"""


@query(f"""WITH {_FOLD_CTE} SELECT 'sample' AS kind, {sql_round('avg(rmse)', 6)} AS rmse_mean, {sql_round('stddev_samp(rmse)', 6)} AS rmse_std,
  {sql_round('avg(r2)', 6)} AS r2_mean, {sql_round('stddev_samp(r2)', 6)} AS r2_std FROM folds
UNION ALL SELECT 'population', {sql_round('avg(rmse)', 6)}, {sql_round('stddev_pop(rmse)', 6)}, {sql_round('avg(r2)', 6)},
  {sql_round('stddev_pop(r2)', 6)} FROM folds""")
def fold_summary(spark, sf):
    folds = S.regression_metrics(_folds(spark, sf), "y", "yhat", ["fold"])
    both = [S.fold_summary(folds, ["rmse", "r2"], ddof).withColumn("kind", F.lit(kind))
            for ddof, kind in ((1, "sample"), (0, "population"))]
    return _rounded(both[0].unionByName(both[1]), 6, "rmse_mean", "rmse_std", "r2_mean", "r2_std")


@query(f"""WITH {V.PREDICTED}, m AS (SELECT l_returnflag, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  1e0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, avg(y - yhat) AS bias FROM predicted GROUP BY 1)
SELECT l_returnflag, CASE WHEN r2 > 0.1e0 THEN 'good' ELSE 'warn' END AS r2_flag,
  CASE WHEN rmse < 20e0 THEN 'good' ELSE 'warn' END AS rmse_flag, CASE WHEN abs(bias) < 0.05e0 THEN 'good' ELSE 'warn' END AS bias_flag
FROM m""")
def quality_flags(spark, sf):
    from annualis.operators.quality import quality_flags as flags

    metrics = S.regression_metrics(V.predicted_orders(spark, sf), "y", "yhat", ["l_returnflag"])
    gates = {"r2": 0.1, "rmse": 20.0, "bias": 0.05}
    return flags(metrics, gates).select("l_returnflag", *[f"{g}_flag" for g in gates])


@query(f"""WITH {V.PREDICTED} SELECT l_returnflag,
  {sql_round('(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100e0)', 6)} AS mape FROM predicted GROUP BY 1""")
def mape(spark, sf):
    return _rounded(S.mape(V.predicted_orders(spark, sf), "y", "yhat", ["l_returnflag"], None), 6, "mape")


_MEASURED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _matrix_columns():
    return [*FEATURES, TARGET]


@query("WITH " + V.MATRIX + " " + " UNION ALL ".join(
    f"SELECT '{b}' AS a, '{a}' AS b, {sql_round(f'corr({a}, {b})', 5)} AS r FROM matrix"
    for i, a in enumerate(_matrix_columns()) for b in _matrix_columns()[i + 1:]))
def corr_matrix(spark, sf):
    return _rounded(S.corr_matrix(stored(matrix(spark, sf), "matrix"), _matrix_columns()), 5, "r")


@query("WITH " + V.MATRIX + " " + " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, '
    f'{sql_round(f"avg({c})", 4)} AS mean, {sql_round(f"stddev_samp({c})", 3)} AS std, '
    + ("CAST(NULL AS DOUBLE)" if c == TARGET else sql_round(f"corr({c}, {TARGET})", 5)) + " AS corr FROM matrix"
    for c in [TARGET, *FEATURES[1:9], "value_normalized"]))
def describe_target(spark, sf):
    out = S.describe_vs_target(matrix(spark, sf), [TARGET, *FEATURES[1:9], "value_normalized"], TARGET)
    return V.round_features(out, {"mean": 4, "std": 3, "corr": 5})


@query("WITH t AS (" + " UNION ALL ".join(f'SELECT \'{c}\' AS "column", {c} AS v FROM lineitem' for c in _MEASURED)
       + f') SELECT "column", {sql_round("quantile_cont(v, 0.5)", 6)} AS median, count(*) AS n FROM t GROUP BY 1')
def medians(spark, sf):
    long = V.table(spark, sf, "lineitem").select(*_MEASURED).unpivot([], _MEASURED, "column", "v")
    out = Q.exact_quantiles(long, ["column"], "v", [0.5])
    return _rounded(out.select("column", F.col("value").alias("median"), "n"), 6, "median")


_HIST = f"""{V.PREDICTED}, e AS (SELECT min(residual) AS lo, max(residual) AS hi, count(*) AS n FROM predicted),
c AS (SELECT least(CAST(floor((residual - lo) / (hi - lo) * 40e0) AS BIGINT), 39) AS bin, count(*) AS n FROM predicted, e GROUP BY 1)"""


@query(f"""WITH {_HIST} SELECT t.bin, {sql_round('(lo + t.bin * ((hi - lo) / 40e0))', 6)} AS "left",
  {sql_round('(lo + (t.bin + 1) * ((hi - lo) / 40e0))', 6)} AS "right", coalesce(c.n, 0) AS n,
  {sql_round('(coalesce(c.n, 0) / (e.n * ((hi - lo) / 40e0)))', 9)} AS density
FROM e, range(40) t(bin) LEFT JOIN c ON c.bin = t.bin""")
def histogram(spark, sf):
    out = S.histogram(V.predicted_orders(spark, sf), "residual", 40)
    return V.round_features(out, {"left": 6, "right": 6, "density": 9})


@query(f"""WITH {V.PREDICTED}, f AS (SELECT avg(residual) AS mu, stddev_pop(residual) AS sigma FROM predicted),
g AS (SELECT i, mu, sigma, mu + sigma * (i * (8e0 / 199) - 4e0) AS x FROM f, range(200) t(i))
SELECT i, {sql_round('x', 6)} AS x, {sql_round('(exp(-0.5e0 * ((x - mu) / sigma) * ((x - mu) / sigma)) / (sigma * sqrt(2e0 * pi())))', 9)} AS density FROM g""")
def normal_curve(spark, sf):
    return V.round_features(S.normal_curve(V.predicted_orders(spark, sf), "residual"), {"x": 6, "density": 9})


_BOX = """q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
box AS (SELECT e.event_type, q1, median, q3,
  min(CASE WHEN value >= q1 - 1.5e0 * (q3 - q1) THEN value END) AS whisker_low,
  max(CASE WHEN value <= q3 + 1.5e0 * (q3 - q1) THEN value END) AS whisker_high,
  count(CASE WHEN value < q1 - 1.5e0 * (q3 - q1) OR value > q3 + 1.5e0 * (q3 - q1) THEN 1 END) AS outliers, count(*) AS n
  FROM events e JOIN q ON q.event_type = e.event_type GROUP BY 1, 2, 3, 4)"""


@query(f"""WITH {_BOX} SELECT event_type, {sql_round('q1', 6)} AS q1, {sql_round('median', 6)} AS median, {sql_round('q3', 6)} AS q3,
  whisker_low, whisker_high, outliers, n FROM box""")
def box_stats(spark, sf):
    return _rounded(Q.box_stats(V.events(spark, sf), ["event_type"], "value"), 6, "q1", "median", "q3")


@query(f"""WITH {_BOX} SELECT event_id, e.event_type, value FROM events e JOIN box ON box.event_type = e.event_type
WHERE value < whisker_low OR value > whisker_high""")
def box_outliers(spark, sf):
    ev = V.events(spark, sf).select("event_id", "event_type", "value")
    return Q.outliers(ev, ["event_type"], "value", Q.box_stats(ev, ["event_type"], "value"))


@query()
def box_stats_approx(spark, sf):
    return Q.box_stats(V.events(spark, sf), ["event_type"], "value", exact=False)


def _quantile_sql(p: str) -> str:
    """``functions.scalar.normal_quantile`` in SQL."""
    def horner(cs, r):
        out = repr(cs[0])
        for c in cs[1:]:
            out = f"({out} * {r} + {c!r})"
        return out.replace("e-", "E-").replace("e+", "E+")

    def num(cs, r):
        text = horner([float(c) for c in cs], r)
        return text

    def ratio(pair, r):
        return f"({num(pair[0], r)} / {num(pair[1], r)})"

    tail = f"sqrt(-ln(CASE WHEN {p} < 0.5e0 THEN {p} ELSE 1e0 - {p} END))"
    central = f"(({p} - 0.5e0) * {ratio(X._CENTRAL, f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))')})"
    outer = (f"(CASE WHEN {tail} <= 5e0 THEN {ratio(X._MIDDLE, f'({tail} - 1.6e0)')} "
             f"ELSE {ratio(X._TAIL, f'({tail} - 5e0)')} END)")
    return f"(CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN {central} ELSE sign({p} - 0.5e0) * {outer} END)"


_QQ = f"""{V.PREDICTED}, ranked AS (SELECT residual, row_number() OVER (ORDER BY residual, l_orderkey, l_linenumber) AS i,
  count(*) OVER () AS n FROM predicted),
placed AS (SELECT i, residual, CASE WHEN i = n THEN pow(0.5e0, 1e0 / n) WHEN i = 1 THEN 1e0 - pow(0.5e0, 1e0 / n)
  ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p FROM ranked),
qq AS (SELECT i, {_quantile_sql('p')} AS theoretical, residual AS ordered FROM placed)"""


def _qq(spark, sf):
    rows = V.predicted_orders(spark, sf).select("residual", F.struct("l_orderkey", "l_linenumber").alias("tie"))
    return Q.qq_points(rows, "residual", "tie")


@query(f"WITH {_QQ} SELECT i, {sql_round('theoretical', 6)} AS theoretical, ordered FROM qq")
def qq_points(spark, sf):
    return _rounded(_qq(spark, sf), 6, "theoretical")


@query(f"""WITH {_QQ} SELECT {sql_round('regr_slope(ordered, theoretical)', 5)} AS slope,
  {sql_round('regr_intercept(ordered, theoretical)', 5)} AS intercept, {sql_round('corr(ordered, theoretical)', 6)} AS r FROM qq""")
def qq_line(spark, sf):
    return V.round_features(Q.qq_line(_qq(spark, sf)), {"slope": 5, "intercept": 5, "r": 6})


@query()
def qq_grid(spark, sf):
    return Q.qq_grid(V.predicted_orders(spark, sf), "residual")


def _quad_sql(by: str, source: str, x: str, y: str) -> str:
    part = f"PARTITION BY {by}" if by else ""
    group = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    det = lambda a, b, c, d, e, f, g, h, i: f"({a}*({e}*{i}-{f}*{h})-{b}*({d}*{i}-{f}*{g})+{c}*({d}*{h}-{e}*{g}))"
    whole = det("n", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4")
    return f"""centred AS (SELECT {group}{x} AS x, {y} AS y, avg({x}) OVER ({part}) AS center, stddev_pop({x}) OVER ({part}) AS scale FROM {source}),
z AS (SELECT *, (x - center) / scale AS z FROM centred),
sums AS (SELECT {group}min(center) AS center, min(scale) AS scale, count(*) AS n, sum(z) AS s1, sum(z*z) AS s2, sum(z*z*z) AS s3,
  sum(z*z*z*z) AS s4, sum(y) AS t0, sum(z*y) AS t1, sum(z*z*y) AS t2, min(x) AS x_min, max(x) AS x_max FROM z {tail}),
fit AS (SELECT {group}center, scale, {det('t0', 's1', 's2', 't1', 's2', 's3', 't2', 's3', 's4')} / {whole} AS c0,
  {det('n', 't0', 's2', 's1', 't1', 's3', 's2', 't2', 's4')} / {whole} AS c1,
  {det('n', 's1', 't0', 's1', 's2', 't1', 's2', 's3', 't2')} / {whole} AS c2, x_min, x_max, n FROM sums)"""


_QUAD_DIGITS = {"center": 6, "scale": 6, "c0": 6, "c1": 6, "c2": 6, "x_min": 6, "x_max": 6}
_QUAD_COLS = ", ".join(f"{sql_round(c, d)} AS {c}" for c, d in _QUAD_DIGITS.items())


@query(f"WITH {V.TRAINING}, {_quad_sql('crop_type', 'training', 'air_temp_c', TARGET)} SELECT crop_type, {_QUAD_COLS}, n FROM fit")
def quad_fit(spark, sf):
    return V.round_features(S.quad_fit(training(spark, sf), "air_temp_c", TARGET, ["crop_type"]), _QUAD_DIGITS)


@query(f"WITH {V.PREDICTED}, {_quad_sql('', 'predicted', 'yhat', 'residual')} SELECT {_QUAD_COLS}, n FROM fit")
def quad_fit_overall(spark, sf):
    return V.round_features(S.quad_fit(V.predicted_orders(spark, sf), "yhat", "residual"), _QUAD_DIGITS)


@query(f"""WITH {V.TRAINING}, {_quad_sql('crop_type', 'training', 'air_temp_c', TARGET)},
g AS (SELECT *, x_min + (x_max - x_min) * (i / 99e0) AS x FROM fit, range(100) t(i)),
gz AS (SELECT *, (x - center) / scale AS z FROM g)
SELECT crop_type, i, {sql_round('x', 6)} AS x, {sql_round('(c0 + z * (c1 + z * c2))', 6)} AS y FROM gz""")
def quad_curve(spark, sf):
    fit = S.quad_fit(training(spark, sf), "air_temp_c", TARGET, ["crop_type"])
    return _rounded(S.quad_eval(fit, ["crop_type"]), 6, "x", "y")


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(
    sql_round(f"(({c} - min({c}) OVER w) / (max({c}) OVER w - min({c}) OVER w + 1e-9))", 6) + f" AS {c}_scaled"
    for c in ["l_quantity", "l_extendedprice"]) + " FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)")
def range_scale(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *columns)
    out = S.range_scale(lines, ["l_returnflag"], columns)
    return _rounded(out.select("l_orderkey", "l_linenumber", *[f"{c}_scaled" for c in columns]), 6,
                    *[f"{c}_scaled" for c in columns])


@query("SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    return S.count_rows(V.table(spark, sf, "lineitem"))


@query("SELECT CAST(coalesce(sum(k), 0) AS BIGINT) AS total FROM (SELECT event_id AS k FROM events WHERE event_type = 'outage')")
def total_or_zero(spark, sf):
    return S.total_or_zero(V.events(spark, sf).filter(F.col("event_type") == "outage"), "event_id")


# --- attributions -------------------------------------------------------------

_INPUTS = list(FEATURES)
_COEF = f"""{V.MATRIX}, coef AS (SELECT {', '.join(
    f'regr_slope({TARGET}, {c}) AS b_{c}, avg({c}) AS m_{c}' for c in _INPUTS)} FROM matrix)"""
_PART = {c: f"b_{c} * ({c} - m_{c})" for c in _INPUTS}


def _attributed(spark, sf):
    rows = stored(matrix(spark, sf, ("reading_id", "crop_type")), "matrix")
    return rows, A.univariate_slopes(rows, _INPUTS, TARGET)


@query(f"WITH {_COEF} " + " UNION ALL ".join(
    f"SELECT reading_id, '{c}' AS feature, {sql_round(e, 6)} AS contribution FROM matrix, coef" for c, e in _PART.items()))
def attributions(spark, sf):
    rows, coef = _attributed(spark, sf)
    return _rounded(A.linear_attributions(rows, ["reading_id"], _INPUTS, coef), 6, "contribution")


_MEAN_ABS = f"""{_COEF}, long AS ({' UNION ALL '.join(
    f"SELECT crop_type, '{c}' AS feature, abs({e}) AS v FROM matrix, coef" for c, e in _PART.items())})"""


@query(f"""WITH {_MEAN_ABS}, m AS (SELECT crop_type, feature, avg(v) AS mean_abs FROM long GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY crop_type ORDER BY mean_abs DESC, feature) AS BIGINT) AS rank FROM m)
SELECT crop_type, feature, {sql_round('mean_abs', 6)} AS mean_abs, rank FROM r WHERE rank <= 5""")
def attributions_top(spark, sf):
    rows, coef = _attributed(spark, sf)
    top = A.top_features(A.mean_abs_attributions(rows, _INPUTS, coef, ["crop_type"]), 5, ["crop_type"])
    return _rounded(top.withColumn("rank", F.col("rank").cast("bigint")), 6, "mean_abs")


@query(f"""WITH {_MEAN_ABS}, m AS (SELECT feature, avg(v) AS mean_abs FROM long GROUP BY 1)
SELECT feature, {sql_round('mean_abs', 6)} AS mean_abs, {sql_round('(mean_abs * 100e0 / (SELECT max(mean_abs) FROM m))', 4)} AS pct_of_max,
  CASE feature {' '.join(f"WHEN '{c}' THEN '{FEATURE_LABELS[c]}'" for c in _INPUTS)} END AS label FROM m""")
def relative_to_max(spark, sf):
    rows, coef = _attributed(spark, sf)
    table = A.importance_table(A.mean_abs_attributions(rows, _INPUTS, coef))
    return V.round_features(table, {"mean_abs": 6, "pct_of_max": 4})


@query()
def attributions_linear_model(spark, sf):
    from annualis.operators.modelling import fit_linear
    rows = stored(matrix(spark, sf, ("reading_id", "crop_type")), "matrix")
    coef = A.model_coefficients(fit_linear(rows), FEATURES, rows)
    return A.top_features(A.mean_abs_attributions(rows, FEATURES, coef), 4)
