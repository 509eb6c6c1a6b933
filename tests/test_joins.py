import datetime as dt

import pytest
from pyspark.sql import functions as F

from annualis.operators import joins as J
from annualis.operators import runs as R
from annualis.schemas import MEASURES


@pytest.fixture
def tables(spark):
    readings = spark.createDataFrame(
        [(1, 10, dt.datetime(2010, 7, 1)), (2, 10, dt.datetime(2010, 8, 1)), (3, 10, dt.datetime(2011, 7, 1)),
         (4, 20, dt.datetime(2010, 7, 1)), (5, 99, dt.datetime(2010, 7, 1))],
        "id bigint, parcel_id bigint, recorded_at timestamp_ntz")
    readings = readings.withColumns({c: F.lit(1.0) for c in MEASURES})
    parcels = spark.createDataFrame([(10, "p", "corn", "France"), (20, "q", "rice", "Nowhere")],
                                    "id bigint, name string, crop_type string, country string")
    outcomes = spark.createDataFrame([(10, 2010, 3.0), (10, 2011, None), (20, 2010, 4.0)],
                                     "parcel_id bigint, harvest_year int, yield_t_per_ha double")
    features = spark.createDataFrame([("France", 2010, 7.0, None, 6.0, 0.5)],
                                     "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    return readings, parcels, outcomes, features


def test_training_set(tables):
    out = {r.id: r for r in J.training_set(*tables, extra=["id"]).collect()}
    assert set(out) == {1, 2, 4}  # both readings of 2010 meet the outcome; unknown outcome and parcel drop out
    assert out[1].yoy_growth_pct == 0.0 and out[1].value_tonnes == 7.0
    assert out[4].value_tonnes is None and out[4].yoy_growth_pct == 0.0


def test_training_set_multiplies_with_duplicate_outcomes(tables):
    readings, parcels, outcomes, features = tables
    assert J.training_set(readings, parcels, outcomes.unionByName(outcomes), features).count() == 6


def test_three_defaults(spark, tables):
    requests = spark.createDataFrame([(1, "France", 2010), (2, "France", 1999), (3, "X", 2010)], "i int, country string, year int")
    features = tables[3]
    got = {r.i: r.value_normalized for r in J.intensity_lookup(requests, features).collect()}
    assert got == {1: 0.5, 2: 0.3, 3: 0.3}
    rich = {r.i: (r.value_tonnes, r.yoy_growth_pct) for r in J.enrich_requests(requests, features.unionByName(features)).collect()}
    assert rich == {1: (7.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}


def test_history_ignores_unknown_parcels_and_breaks_ties(spark, tables):
    when = dt.datetime(2020, 1, 1)
    log = spark.createDataFrame(
        [(1, 10, when), (2, 10, when), (3, 99, dt.datetime(2021, 1, 1)), (4, 20, dt.datetime(2019, 1, 1))],
        "id bigint, parcel_id bigint, predicted_at timestamp_ntz").withColumns(
        {c: F.lit(1.0) for c in ("predicted_yield", "irrigation_rec_mm", "confidence")}).withColumns(
        {c: F.lit("m") for c in ("model_name", "model_version")})
    out = J.prediction_history(log, tables[1], 2).collect()
    assert [r.id for r in out] == [2, 1] and out[0].parcel_name == "p" and len(out[0]) == 11
    with pytest.raises(ValueError):
        J.prediction_history(log, tables[1], 501)


def test_spine_and_overlay(spark):
    e = spark.createDataFrame([("A",), ("B",)], "area string")
    assert J.spine(e, 2010, 2016, copies=3, copy_name="i").count() == 2 * 7 * 3
    past = spark.createDataFrame([("A", 2016, 1.0)], "area string, year int, value_tonnes double")
    ahead = spark.createDataFrame([("A", 2017, 2.0, 1.0, 3.0)], "area string, year int, yhat double, yhat_lower double, yhat_upper double")
    assert [(str(r.ds), r.kind, r.value) for r in J.overlay(past, ahead).orderBy("ds").collect()] == [
        ("2016-01-01", "history", 1.0), ("2017-01-01", "forecast", 2.0)]


def test_runs(spark):
    runs = spark.createDataFrame(
        [("e", 1, 30, 0.7, 0.5, 0.8), ("e", 2, 10, 0.6, 0.6, None), ("e", 3, 20, 0.6, None, 0.9), ("f", 4, 5, None, None, None)],
        "experiment string, run_id bigint, start_time bigint, rmse double, mae double, r2 double")
    versions = R.run_versions(runs)
    assert {r.run_id: r.version for r in versions.collect()} == {2: 1, 3: 2, 1: 3, 4: 1}
    assert {r.experiment: r.run_id for r in R.latest_run(runs).collect()} == {"e": 1, "f": 4}
    best = {r.experiment: r for r in R.best_run(versions, ["experiment"]).collect()}
    assert (best["e"].best_rmse_version, best["e"].best_mae_version, best["e"].best_r2_version) == (1, 3, 2)
    assert best["f"].best_rmse_version is None


def test_hot_parcel_keeps_all_rows(spark):
    """A third of the readings belong to one parcel; the join is sort-merge and split by AQE."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 6000
        ids = spark.range(n)
        parcel = F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 500)
        readings = ids.select("id", parcel.cast("bigint").alias("parcel_id"), F.lit("2010-07-01").cast("timestamp_ntz").alias("recorded_at"),
                              *[F.rand(i).alias(c) for i, c in enumerate(MEASURES)])
        parcels = spark.range(500).select("id", F.lit("corn").alias("crop_type"), F.lit("F").alias("country"))
        outcomes = spark.range(500).select(F.col("id").alias("parcel_id"), F.lit(2010).alias("harvest_year"), F.lit(1.0).alias("yield_t_per_ha"))
        features = spark.createDataFrame([("F", 2010, 1.0, 1.0, 1.0, 1.0)],
                                         "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
        out = J.training_set(readings, parcels, outcomes, features, extra=["id"])
        assert out.select("id").distinct().count() == n and out.count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_row_without_value_does_not_win(spark):
    dim = spark.createDataFrame([("A", 2000, None, 1.0, 1.0, 1.0), ("A", 2000, 7.0, 2.0, 2.0, 2.0)],
                                "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    out = J.enrich_requests(spark.createDataFrame([("A", 2000)], "country string, year int"), dim).first()
    assert (out["value_tonnes"], out["ma5_tonnes"]) == (7.0, 2.0)
