import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annualis import session
from annualis.operators import attribution as A
from annualis.operators import quantiles as Q
from annualis.operators import stats as S


@pytest.fixture(scope="module")
def data(spark):
    """A hot class, heavy ties, and a NULL value."""
    rng = np.random.default_rng(3)
    n = 4000
    pdf = pd.DataFrame({
        "g": np.where(np.arange(n) < 2600, "hot", rng.choice(["a", "b"], n)),
        "x": rng.normal(20, 5, n), "w": rng.exponential(2, n).round(1),
    })
    pdf["y"] = 3 + 0.2 * pdf.x - 0.01 * pdf.x**2 + rng.normal(0, 0.3, n)
    pdf.loc[pdf.index % 3 == 0, "w"] = 1.5
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


@pytest.mark.parametrize("actual, predicted, want", [
    ([100], [110], 10.0), ([100], [90], 10.0), ([0, 100, 200], [50, 110, 220], 10.0), ([0, 0], [1, 2], None),
    ([100, 200, 400], [90, 220, 400], 6.67), ([1000] * 100, [1050] * 100, 5.0), ([100, 200, 300], [100, 200, 300], 0.0),
])
def test_mape(spark, actual, predicted, want):
    df = spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "y double, yhat double")
    assert S.mape(df, "y", "yhat").first()["mape"] == want


def test_mean_mape_skips_entities_without_a_score(spark):
    scores = spark.createDataFrame([("a", 10.0), ("b", None), ("c", 5.0)], "k string, mape double")
    assert S.mean_mape(scores).first()["avg_mape"] == 7.5


def test_regression_metrics(data):
    pdf, df = data
    out = S.regression_metrics(df.withColumn("p", F.col("x") * 0.1), "y", "p").first()
    r = (pdf.y - pdf.x * 0.1).to_numpy()
    want = [np.sqrt(np.mean(r**2)), np.mean(np.abs(r)), 1 - (r**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum(), r.mean(), r.std()]
    assert [out.rmse, out.mae, out.r2, out.bias, out.sigma] == pytest.approx(want, rel=1e-9)
    assert out.n == len(pdf)


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert S.regression_metrics(df, "y", "p").first()["r2"] is None


def test_corr_matrix_with_nulls_and_a_constant(spark, data):
    pdf, df = data
    wide = df.withColumn("n", F.when(F.col("x") > 18, F.col("w"))).withColumn("c", F.lit(1.0))
    out = {(r.a, r.b): r.r for r in S.corr_matrix(wide, ["x", "y", "w", "n", "c"]).collect()}
    ref = pdf.assign(n=pdf.w.where(pdf.x > 18))[["x", "y", "w", "n"]].corr()
    assert len(out) == 10
    for (a, b), r in out.items():
        if "c" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(ref.loc[a, b], abs=1e-9)


@pytest.mark.parametrize("bins, cell_rows, broadcast_rows", [(4096, 10**6, 10**5), (16, 1000, 10**5), (4, 50, 10**5), (2, 1, 10**5), (64, 1000, 0)])
def test_exact_quantiles(data, bins, cell_rows, broadcast_rows, monkeypatch):
    pdf, df = data
    monkeypatch.setattr(session, "BROADCAST_ROWS", broadcast_rows)
    qs = [0.0, 0.25, 0.5, 0.75, 0.937, 1.0]
    for c in ("x", "w"):
        got = Q.exact_quantiles(df, ["g"], c, qs, cell_rows, bins).toPandas()
        assert len(got) == 3 * len(qs)
        for r in got.itertuples():
            assert r.value == pytest.approx(np.quantile(pdf[pdf.g == r.g][c], r.q), rel=1e-12)
    overall = {r.q: r.value for r in Q.exact_quantiles(df, [], "w", qs, cell_rows, bins).collect()}
    assert overall == pytest.approx({q: np.quantile(pdf.w, q) for q in qs})


def test_quantiles_with_a_far_outlier_and_infinity(spark):
    values = [float(i) for i in range(400)] + [1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = {r.q: r.value for r in Q.exact_quantiles(df, [], "v", [0.25, 0.5], cell_rows=10, bins=16).collect()}
    assert out == {0.25: 100.0, 0.5: 200.0}
    endless = df.unionByName(spark.createDataFrame([(float("inf"),), (float("nan"),)], "v double"))
    assert Q.exact_quantiles(endless, [], "v", [0.5], cell_rows=10, bins=16).first().value == 200.5


def test_box_stats_and_fits_of_many_keys_are_salted(data, monkeypatch):
    pdf, df = data
    want = {tuple(r) for r in Q.box_stats(df, ["g"], "w").collect()}
    fits = {r.g: (r.c0, r.c1, r.c2) for r in S.quad_fit(df, "x", "y", ["g"]).collect()}
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    salted = Q.box_stats(df, ["g"], "w")
    assert {tuple(r) for r in salted.collect()} == want
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    for r in S.quad_fit(df, "x", "y", ["g"]).collect():
        assert (r.c0, r.c1, r.c2) == pytest.approx(fits[r.g])


def test_quantiles_of_tiny_groups(spark):
    df = spark.createDataFrame([("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)], "g string, v double")
    out = {(r.g, r.q): r.value for r in Q.exact_quantiles(df, ["g"], "v", [0.25, 0.5]).collect()}
    assert out == {("one", 0.25): 5.0, ("one", 0.5): 5.0, ("two", 0.25): 1.25, ("two", 0.5): 1.5}


def test_box_stats(data):
    pdf, df = data
    boxes = Q.box_stats(df, ["g"], "w")
    for r in boxes.collect():
        v = pdf[pdf.g == r.g].w
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r.q1, r.q3, r.whisker_low, r.whisker_high) == pytest.approx((q1, q3, inside.min(), inside.max()))
        assert r.outliers == len(v) - len(inside) and r.n == len(v)
    assert Q.outliers(df, ["g"], "w", boxes).count() == boxes.agg(F.sum("outliers")).first()[0]


def test_approx_quantiles_have_the_same_columns(data):
    _, df = data
    exact, approx = (f(df, ["g"], "x", [0.5]) for f in (Q.exact_quantiles, Q.approx_quantiles))
    assert exact.columns == approx.columns
    both = exact.join(approx.withColumnRenamed("value", "a"), ["g", "q"]).collect()
    assert all(abs(r.value - r.a) < 0.1 for r in both)


def test_histogram_lists_empty_bins_and_integrates_to_one(spark, data):
    pdf, df = data
    out = S.histogram(df, "x", 40).orderBy("bin").toPandas()
    counts, edges = np.histogram(pdf.x, 40)
    assert out["n"].tolist() == counts.tolist()
    assert out["left"].tolist() == pytest.approx(edges[:-1].tolist())
    assert ((out["right"] - out["left"]) * out["density"]).sum() == pytest.approx(1.0)
    flat = S.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).orderBy("bin").toPandas()
    assert flat["n"].tolist() == np.histogram([2.0, 2.0], 4)[0].tolist()


def test_normal_curve(data):
    from statistics import NormalDist

    pdf, df = data
    out = S.normal_curve(df, "x", 5).orderBy("i").collect()
    fit = NormalDist(pdf.x.mean(), pdf.x.std(ddof=0))
    assert [r.x for r in out] == pytest.approx([fit.mean + k * fit.stdev for k in (-4, -2, 0, 2, 4)])
    assert [r.density for r in out] == pytest.approx([fit.pdf(r.x) for r in out])


def test_quadratic_fit(data):
    pdf, df = data
    for r in S.quad_fit(df, "x", "y", ["g"]).collect():
        part = pdf[pdf.g == r.g]
        c2, c1, c0 = np.polyfit((part.x - r.center) / r.scale, part.y, 2)
        assert [r.c0, r.c1, r.c2] == pytest.approx([c0, c1, c2], abs=1e-8)
    curve = S.quad_eval(S.quad_fit(df, "x", "y"), points=3).orderBy("i").collect()
    want = np.polyval(np.polyfit(pdf.x, pdf.y, 2), [pdf.x.min(), (pdf.x.min() + pdf.x.max()) / 2, pdf.x.max()])
    assert [r.y for r in curve] == pytest.approx(want.tolist(), abs=1e-6)


def test_quadratic_fit_of_two_points_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (2.0, 4.0)], "x double, y double")
    row = S.quad_fit(df, "x", "y").first()
    assert (row.c0, row.c1, row.c2) == (None, None, None)


def test_qq_points(data):
    from statistics import NormalDist

    pdf, df = data
    out = Q.qq_points(df.withColumn("tie", F.monotonically_increasing_id()), "x", "tie", partitions=5).orderBy("i").toPandas()
    n = len(pdf)
    assert out["ordered"].tolist() == sorted(pdf.x)
    assert out["theoretical"].iloc[0] == pytest.approx(NormalDist().inv_cdf(1 - 0.5 ** (1 / n)))
    assert out["theoretical"].iloc[9] == pytest.approx(NormalDist().inv_cdf((10 - 0.3175) / (n + 0.365)))


def test_fold_summary(spark):
    folds = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "rmse double")
    sample, population = (S.fold_summary(folds, ["rmse"], d).first()["rmse_std"] for d in (1, 0))
    assert (sample, population) == pytest.approx((np.std([1, 2, 4], ddof=1), np.std([1, 2, 4])))


def test_describe(data):
    pdf, df = data
    out = {r["column"]: r for r in S.describe_vs_target(df, ["y", "x"], "y").collect()}
    assert out["y"]["corr"] is None
    assert out["x"]["corr"] == pytest.approx(pdf.x.corr(pdf.y)) and out["x"]["std"] == pytest.approx(pdf.x.std())


def test_attributions(data):
    pdf, df = data
    coef = A.univariate_slopes(df, ["x", "w"], "y")
    long = A.linear_attributions(df, ["g"], ["x", "w"], coef)
    assert long.count() == 2 * len(pdf)
    b = np.polyfit(pdf.x, pdf.y, 1)[0]
    means = {(r.g, r.feature): r.mean_abs for r in A.mean_abs_attributions(df, ["x", "w"], coef, ["g"]).collect()}
    part = pdf[pdf.g == "hot"]
    assert means[("hot", "x")] == pytest.approx((b * (part.x - pdf.x.mean())).abs().mean())
    top = A.top_features(A.mean_abs_attributions(df, ["x", "w"], coef, ["g"]), 1, ["g"])
    assert top.count() == 3


def test_relative_to_max_of_zeros_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "k string, v double")
    assert {r.pct_of_max for r in S.relative_to_max(df, "v").collect()} == {None}


def test_metrics_ignore_rows_without_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.5), (100.0, None), (None, 3.0)], "y double, p double")
    r = S.regression_metrics(df, "y", "p").first()
    assert (r["n"], round(r["r2"], 9)) == (2, 0.5)


def test_box_stats_ignore_nan(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("a", float("nan")), ("a", None), (None, 1.0)], "k string, v double")
    boxes = Q.box_stats(df, ["k"], "v")
    got = {r["k"]: (r["n"], r["outliers"], r["median"]) for r in boxes.collect()}
    assert got == {"a": (9, 0, 4.0), None: (1, 0, 1.0)}
    assert Q.outliers(df, ["k"], "v", boxes).count() == 0


def test_quantiles_do_not_depend_on_the_way(spark):
    """Ties, infinities, tiny and huge values: bit for bit the same for any size of cell."""
    rng = np.random.default_rng(0)
    values = [*rng.normal(size=300), *([1.25] * 60), *(rng.normal(size=40) * 1e-300), 1.7e308, -1.7e308, *([float("inf")] * 5), *([float("-inf")] * 3), -0.0, 0.0]
    rows = [(None if k % 3 == 0 else "ab"[k % 2], float(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v double")
    qs = [0.0, 0.01, 0.33, 0.5, 0.77, 0.99, 1.0]
    collect = lambda d: sorted((str(r["k"]), r["q"], repr(r["value"]), r["n"]) for r in d.collect())
    plain = collect(Q.exact_quantiles(df, ["k"], "v", qs))
    for cell_rows, bins in ((100, 4096), (7, 16), (1, 2)):
        assert collect(Q.exact_quantiles(df, ["k"], "v", qs, cell_rows, bins)) == plain


def test_quad_fit_does_not_depend_on_the_number_of_rows(spark):
    rare = [(0.0, 1.0), (1.0, 2.0)] * 3000 + [(0.5, 9.0)]
    two = [(0.0, 1.0), (1.0, 2.0)] * 3000
    assert S.quad_fit(spark.createDataFrame(rare, "x double, y double"), "x", "y").first()["c2"] is not None
    assert S.quad_fit(spark.createDataFrame(two, "x double, y double"), "x", "y").first()["c2"] is None


def test_large_tables_are_not_copied_for_cold_keys(spark, monkeypatch):
    """Beyond the broadcast bound only hot keys are spread; rows are those of a plain join, NULL keys included."""
    left = spark.createDataFrame([(None if k % 9 == 0 else k % 5, k) for k in range(200)], "k int, v int")
    right = spark.createDataFrame([(k, k * 10) for k in range(4)] + [(None, -1)], "k int, w int")
    rows = lambda how: sorted(map(str, session.attach(left, right, ["k"], "t", how).collect()))
    plain = {how: rows(how) for how in ("inner", "left", "left_anti")}
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(session, "HOT_ROWS", 30)
    assert {how: rows(how) for how in plain} == plain
    assert len(plain["left"]) == 200 and len(plain["left_anti"]) == sum(1 for k in range(200) if k % 9 and k % 5 == 4)
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            rows(how)
