import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annualis.operators import forecast as FC
from annualis.operators import modelling as M
from annualis.operators import scoring as P
from annualis.operators.boosting import Params
from annualis.schemas import BOOST_PARAMS, CROP_CLASSES, CUTOFF_YEAR, FEATURES, HORIZON, MEASURES, RESPONSE_COEFFICIENTS, RESPONSE_CONFIG, SERIES_INPUTS, TARGET, TOP_ENTITIES


@pytest.fixture(scope="module")
def frame(spark):
    """A row per class and another one, made from their number; two of them have holes."""
    crops = [*CROP_CLASSES, CROP_CLASSES[2]]
    rows = pd.DataFrame({"crop_type": crops, "country": "Atlantis", "year": [2010 + k for k in range(6)]})
    for step, name in enumerate((*MEASURES, *SERIES_INPUTS), start=1):
        rows[name] = [step * (k + 1) / 4 for k in range(6)]
    rows[TARGET] = [1.5 + k / 2 for k in range(6)]
    rows.loc[0, "soil_moisture"] = None
    rows.loc[1, "value_tonnes"] = None
    return spark.createDataFrame(rows)


def test_fixed_parameters(spark):
    assert (CUTOFF_YEAR, TOP_ENTITIES, HORIZON) == (2013, 10, 5)
    assert (BOOST_PARAMS["trees"], BOOST_PARAMS["depth"], BOOST_PARAMS["step"]) == (300, 6, 0.05)
    assert len(FEATURES) == 13 and FEATURES[0] == "crop_encoded" and FEATURES[-1] == "value_normalized"
    assert CROP_CLASSES == sorted(CROP_CLASSES)
    p = Params.of()
    assert (p.trees, p.depth, p.step, p.row_sample, p.column_sample, p.min_rows, p.l1, p.l2, p.seed) == (300, 6, 0.05, 0.8, 0.8, 3, 0.1, 1.0, 42)
    with pytest.raises(ValueError):
        Params.of({"leaves": 3})


def test_feature_matrix(frame):
    out = M.feature_matrix(frame)
    assert out.columns == [*FEATURES, TARGET]
    rows = out.orderBy("year").collect()
    assert [r.crop_encoded for r in rows] == [0, 1, 2, 3, 4, 2]
    assert rows[0].soil_moisture == 0.0 and rows[1].value_tonnes == 0.0
    assert [r[TARGET] for r in rows] == [1.5, 2.0, 2.5, 3.0, 3.5, 4.0]
    assert frame.filter("isnan(soil_moisture)").count() == 1  # the input is as it was


def test_observed_classes(frame):
    assert {r.crop_type: r.code for r in M.observed_classes(frame).collect()} == {c: i for i, c in enumerate(CROP_CLASSES)}


def test_splits_do_not_depend_on_partitioning(spark):
    def parts(df):
        marked = M.with_fold(M.split_random(df, ["id"]), ["id"])
        return {r.id: (r.is_test, r.fold) for r in marked.collect()}

    one = parts(spark.range(0, 5000, 1, 2))
    assert one == parts(spark.range(0, 5000, 1, 11))
    assert 0.17 < np.mean([t for t, _ in one.values()]) < 0.23
    sizes = np.bincount([f for _, f in one.values()])[1:]
    assert len(sizes) == 5 and sizes.min() > 850


@pytest.fixture(scope="module")
def matrix(spark):
    df = spark.range(600).withColumns({c: F.rand(i) * 10 for i, c in enumerate(FEATURES)})
    return df.withColumn(TARGET, F.col("air_temp_c") * 2 + F.col("rainfall_mm")).cache()


def test_boosted_trees_and_cross_validation(spark, matrix):
    model = M.fit_yield(matrix, {"trees": 5, "depth": 3})
    top = M.top_importances(M.importances(spark, model), 1).first()
    assert top.feature == "air_temp_c"
    predicted = M.cross_validate(M.with_fold(matrix, ["id"], 3), 3, {"trees": 40, "depth": 3}, keys=["id"])
    assert predicted.select("id").distinct().count() == 600 == predicted.count()
    metrics = M.fold_metrics(predicted)
    assert metrics.count() == 3 and metrics.agg(F.sum("n")).first()[0] == 600
    assert M.cv_summary(predicted).first()["r2_mean"] > 0.5


def test_linear_attributions_of_a_fitted_model(matrix):
    from annualis.operators.attribution import mean_abs_attributions, model_coefficients, top_features

    coef = model_coefficients(M.fit_linear(matrix), FEATURES, matrix)
    top = top_features(mean_abs_attributions(matrix, FEATURES, coef), 2).orderBy("rank").collect()
    assert [r.feature for r in top] == ["air_temp_c", "rainfall_mm"]


# --- response score ----------------------------------------------------------------


def expected(crop, intensity, ph, moisture, nitrogen, temp, rain):
    base, opt_temp, opt_rain = RESPONSE_CONFIG[crop]
    k = RESPONSE_COEFFICIENTS
    share = 1 + k["climate"] + k["intensity_gain"] * math.log1p(k["intensity_rate"] * intensity) + k["moisture"] * moisture + k["nitrogen"] * nitrogen
    share += k["ph"] * (ph - k["best_ph"]) ** 2 + k["temperature"] * (temp - opt_temp) ** 2 + k["rain"] * (rain - opt_rain) ** 2
    return max(k["least"], base * share)


#: Each class at steps of every measure, from too little to too much.
CASES = [(crop, k / 4, 5.0 + k, 0.2 * k, 60.0 * k, 9.0 * k, 400.0 * k * k) for crop in RESPONSE_CONFIG for k in range(5)]


def scores(spark, cases, **how):
    names = "crop_type string, value_normalized double, soil_ph double, soil_moisture double, nitrogen_ppm double, air_temp_c double, rainfall_mm double"
    df = spark.createDataFrame(cases, names).coalesce(1).withColumn("i", F.monotonically_increasing_id())
    return [r.score for r in P.response_score(df, **how).orderBy("i").collect()]


def test_response_formula(spark):
    assert scores(spark, CASES) == pytest.approx([round(expected(*c), 3) for c in CASES], abs=1e-3)


def test_response_of_an_unknown_class_is_null(spark):
    assert scores(spark, [("banana", .7, 6.5, .3, 90., 28., 1200.)]) == [None]


def test_response_moves_the_right_way_and_stays_positive(spark):
    best, bad_ph, no_input, hot = scores(spark, [
        ("rice", .7, 6.5, .3, 90., 28., 1200.), ("rice", .7, 8.9, .3, 90., 28., 1200.),
        ("rice", 0., 6.5, .3, 90., 28., 1200.), ("rice", .7, 6.5, .3, 90., 44., 1200.)])
    assert best > bad_ph and best > no_input and best > hot
    rng = np.random.default_rng(42)
    many = [(c, *map(float, (rng.uniform(0, 1), rng.uniform(5, 8.5), rng.uniform(.1, .8), rng.uniform(30, 250), rng.uniform(0, 40), rng.uniform(100, 3000))))
            for c in RESPONSE_CONFIG for _ in range(50)]
    assert min(scores(spark, many)) >= 0.1
    assert min(scores(spark, many, noise_seed=1, noise_key="i")) >= 0.1
    assert scores(spark, many, noise_seed=1, noise_key="i") == scores(spark, many, noise_seed=1, noise_key="i")


def test_irrigation(spark):
    df = spark.createDataFrame([("wheat", 320.0), ("corn", 700.0), ("other", 100.0), ("rice", None)], "crop_type string, rainfall_mm double")
    assert [r.irrigation_rec_mm for r in P.irrigation(df).collect()] == [180.0, 0.0, 500.0, None]


def test_score_rejects_and_clamps(spark, frame):
    requests = frame.drop("value_tonnes", "yoy_growth_pct", "ma5_tonnes", "value_normalized", TARGET)
    requests = requests.withColumn("crop_type", F.when(F.col("year") == 2010, F.lit("banana")).otherwise(F.col("crop_type")))
    features = spark.createDataFrame([("Atlantis", 2011, 5.0, None, 5.0, 0.5)],
                                     "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    scored, rejects = P.score(requests, features, lambda df: df.withColumn("prediction", F.lit(-3.0)))
    assert rejects.count() == 1 and scored.count() == 5
    assert {r.predicted_yield for r in scored.collect()} == {0.0}


# --- forecasts ----------------------------------------------------------------------


SERIES = "area string, year int, value_tonnes double"


def test_line_forecast(spark):
    df = spark.createDataFrame([("A", 2000 + i, 10.0 + 2 * i) for i in range(17)] + [("B", 2010, 5.0), ("C", 2015, 1.0)]
                               + [("D", 2000 + i, 100.0 - 9 * i) for i in range(17)], SERIES)
    out = {}
    for r in FC.forecast_trend(df).collect():
        out.setdefault(r.area, []).append(r)
    assert set(out) == {"A", "B", "D"}  # C has no point up to the cutoff
    a = sorted(out["A"], key=lambda r: r.year)
    assert [r.year for r in a] == [2017, 2018, 2019, 2020, 2021] and a[0].ds == "2017-01-01"
    assert [r.yhat for r in a] == [44.0, 46.0, 48.0, 50.0, 52.0]
    assert a[0].yhat_lower == pytest.approx(44.0, abs=1e-3)
    assert {r.yhat for r in out["B"]} == {5.0} and {r.yhat_lower for r in out["B"]} == {None}
    assert {r.year for r in out["B"]} == {2011, 2012, 2013, 2014, 2015}
    d = min(out["D"], key=lambda r: r.year)
    assert d.yhat == 0.0 and d.yhat_upper < 0  # the bounds are not clamped
    scores = {r.area: r.mape for r in FC.forecast_holdout(df).collect()}
    assert scores["A"] == 0.0 and set(scores) == {"A", "D"}


def test_interval_equals_textbook(spark):
    rng = np.random.default_rng(1)
    x, y = np.arange(2000, 2014), rng.normal(50, 5, 14)
    df = spark.createDataFrame([("A", int(a), float(b)) for a, b in zip(x, y)], SERIES)
    r = FC.forecast_trend(df, horizon=1, digits=None).first()
    b, a = np.polyfit(x - 2000, y, 1)
    s = np.sqrt(((y - a - b * (x - 2000)) ** 2).sum() / 12)
    half = 1.959963984540054 * s * np.sqrt(1 + 1 / 14 + (2014 - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert (r.yhat, r.yhat_upper - r.yhat) == pytest.approx((a + b * 14, half))


def test_hinge_sums_equal_the_design_matrix():
    rng = np.random.default_rng(2)
    t, y = rng.uniform(0, 1, 400), rng.normal(0, 1, 400)
    knots = np.arange(1, 6) * 0.8 / 5
    segment = np.minimum((t / 0.16).astype(int), 5)
    sums = np.array([[np.sum(w) for w in (np.ones(m.sum()), t[m], t[m] ** 2, y[m], t[m] * y[m], y[m] ** 2)]
                     for m in (segment == s for s in range(6))])
    gram, right, syy, n = FC.hinge_system(sums, knots)
    design = np.column_stack([np.ones(400), t, np.maximum(0, t[:, None] - knots)])
    assert np.allclose(gram, design.T @ design) and np.allclose(right, design.T @ y) and n == 400
    beta, sigma, converged = FC.solve_hinges(gram, right, syy, n, prior=0.3)
    slack = right[2:] - gram[2:] @ beta  # optimality of the penalised fit
    assert converged and np.all(np.abs(slack) <= sigma**2 / 0.3 + 1e-6)


def test_hinge_fits_are_minima():
    """A thousand series: the conditions of the minimum hold, and the noise is that of the residuals."""
    rng = np.random.default_rng(8)
    knots = np.arange(1, 26) * 0.8 / 25
    for case in range(1_000):
        n = int(rng.integers(3, 40))
        t = np.linspace(0, 1, n)
        y = np.cumsum(rng.normal(0, 1, n)) if case % 2 else rng.normal(0, 1, n) + t
        y /= np.abs(y).max()
        design = np.column_stack([np.ones(n), t, np.maximum(0, t[:, None] - knots)])
        gram, right, syy = design.T @ design, design.T @ y, float(y @ y)
        beta, sigma, converged = FC.solve_hinges(gram, right, syy, n, prior=0.3)
        penalty = sigma**2 / 0.3
        slope = gram @ beta - right
        slope[:2] += sigma**2 / 25 * beta[:2]
        bent = beta[2:] != 0
        assert converged, case
        assert np.abs(slope[:2]).max() < 1e-6 and np.abs(slope[2:][bent] + penalty * np.sign(beta[2:][bent])).max(initial=0) < 1e-6, case
        assert np.abs(slope[2:]).max(initial=0) <= penalty + 1e-6, case
        assert abs(sigma**2 - max(((y - design @ beta) ** 2).sum() / n, 1e-8)) < 1e-6, case


def test_piecewise_follows_a_bend(spark):
    values = [float(10 + i) if i < 60 else 70.0 + 5 * (i - 60) for i in range(100)]
    df = spark.createDataFrame([("A", 1900 + i, v) for i, v in enumerate(values)], SERIES)
    out = FC.forecast_piecewise(df, cutoff=1999).orderBy("year").collect()
    assert [r.year for r in out] == list(range(2000, 2005))
    assert out[0].yhat == pytest.approx(270, rel=0.03) and out[0].yhat_lower < out[0].yhat < out[0].yhat_upper
    assert out[4].yhat_upper - out[4].yhat_lower > out[0].yhat_upper - out[0].yhat_lower


def test_piecewise_holdout(spark):
    """The score is that of the trend beyond the cutoff; a straight line scores nearly nothing."""
    df = spark.createDataFrame([("A", 1950 + i, 10.0 + 2 * i) for i in range(60)] + [("B", 1950 + i, 5.0 + i * (1 if i < 55 else 3)) for i in range(60)], SERIES)
    out = {r.area: r.mape for r in FC.piecewise_holdout(df, cutoff=1999).collect()}
    assert out["A"] < 1 and 3 < out["B"] < 60


def test_unknown_parameters_are_refused(spark):
    with pytest.raises(ValueError):
        M.fit_yield(None, {"leaves": 0.1})


def test_training_run(matrix):
    model, row = M.train_run(matrix, ["id"], params={"trees": 2, "depth": 3}, k=3)
    r = row.first()
    assert r["train_rows"] + r["test_rows"] == 600 and r["importance_air_temp_c"] > 0.5 and r["cv_rmse_std"] >= 0
    assert model.trees["tree"].nunique() == 2


def test_piecewise_sees_only_sums(spark):
    """A long entity reaches the Python step as one row per segment."""
    df = spark.range(20000).select(F.lit("A").alias("area"), F.col("id").cast("int").alias("year"), F.rand(1).alias("value_tonnes"))
    sums = FC._segment_sums(df, "area", "year", "value_tonnes", 10**6, 25, 0.8)
    assert sums.count() == 26 and sums.agg(F.sum("n")).first()[0] == 20000
