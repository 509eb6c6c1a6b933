"""Saved models: written, named by a run, loaded anew and used by batch and stream jobs."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from annualis.operators import modelling as M
from annualis.operators import saved
from annualis.operators import scoring as P
from annualis.schemas import CROP_CLASSES, FEATURES, MEASURES, SERIES_INPUTS, TARGET
from annualis.streaming.jobs import stream_score


@pytest.fixture(scope="module")
def matrix(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("matrix") / "m")
    df = spark.range(500).withColumns({c: (F.xxhash64("id", F.lit(i)) % 1000) / 100.0 for i, c in enumerate(FEATURES)})
    df.withColumn(TARGET, F.abs("air_temp_c") * 2 + F.abs("rainfall_mm")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def requests(spark):
    df = spark.range(60).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").alias("parcel_id"), F.lit("Atlantis").alias("country"),
                                (F.lit(2000) + F.col("id") % 4).cast("int").alias("year"),
                                F.element_at(F.array(*[F.lit(c) for c in [*CROP_CLASSES, "banana"]]), (F.col("id") % 6 + 1).cast("int")).alias("crop_type"))
    return df.withColumns({c: (F.col("event_id") * (i + 1) % 37).cast("double") for i, c in enumerate(MEASURES)})


@pytest.fixture(scope="module")
def features(spark):
    return spark.range(4).select(F.lit("Atlantis").alias("area"), (F.lit(2000) + F.col("id")).cast("int").alias("year"),
                                 *[(F.col("id") * 1.5).alias(c) for c in SERIES_INPUTS])


def test_saved_model_scores_as_the_fitted_one(spark, matrix, requests, features, tmp_path):
    params = {"trees": 8, "depth": 4}
    booster, row = M.train_run(matrix, ["id"], params=params, k=2)
    runs = str(tmp_path / "runs")
    saved.log_trained(booster, row, runs, "run-1", str(tmp_path / "model-1"), params)
    other, row = M.train_run(matrix, ["id"], params={"trees": 1}, k=2)
    saved.log_trained(other, row, runs, "run-2", str(tmp_path / "model-2"), {"trees": 1})
    logged = spark.read.parquet(runs)
    assert saved.model_path(logged) == str(tmp_path / "model-2") and saved.model_path(logged, "run-1") == str(tmp_path / "model-1")
    with pytest.raises(LookupError):
        saved.model_path(logged, "run-3")
    model = saved.load_model(spark, logged, "run-1")
    assert isinstance(model, PipelineModel) and model.stages[1].booster is not booster
    direct, rejects = P.score(requests, features, booster)
    again, _ = P.score(requests, features, model)
    pairs = lambda df: sorted((r["event_id"], r["predicted_yield"], r["irrigation_rec_mm"]) for r in df.collect())
    assert pairs(direct) == pairs(again) and len(pairs(again)) == 50 and rejects.count() == 10
    assert len({p for _, p, _ in pairs(again)}) > 5
    path = str(tmp_path / "requests")
    requests.write.parquet(path)
    stream = spark.readStream.schema(requests.schema).parquet(path)
    stream_score(stream, features, model, str(tmp_path / "log"), str(tmp_path / "state"), "trees", 0.9)
    assert pairs(spark.read.parquet(str(tmp_path / "log"))) == pairs(direct)


def test_saved_class_list_stays_with_the_model(spark, matrix, requests, features, tmp_path):
    booster = M.fit_yield(matrix, {"trees": 2}, keys=["id"])
    saved.save_model(booster, str(tmp_path / "m"), ["wheat", "rice"])
    model = PipelineModel.load(str(tmp_path / "m"))
    out = model.transform(requests.join(features.withColumnRenamed("area", "country"), ["country", "year"]))
    assert {(r["crop_type"], r["crop_encoded"]) for r in out.collect()} == {("rice", 0), ("wheat", 1)}
    with pytest.raises(Exception):
        saved.save_model(booster, str(tmp_path / "m"))
