"""Fitted models as saved pipelines: written once, named in the run table by their path, loaded by batch and stream jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis.operators.boosting import Booster
from annualis.operators.cleaning import fill_features, split_valid
from annualis.operators.modelling import encode
from annualis.schemas import CROP_CLASSES, FEATURES
from annualis.sources.sinks import log_run


class RequestInputs(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Rows of a known class with the model's inputs: the class encoded by the list that the model was fitted with, NULL and NaN as 0."""

    classes = Param(Params._dummy(), "classes", "known classes, coded by their place in the alphabet", TypeConverters.toListString)
    inputs = Param(Params._dummy(), "inputs", "columns of the model", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, classes: Sequence[str] | None = None, inputs: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(classes=list(CROP_CLASSES), inputs=list(FEATURES))
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.classes)
        good, _ = split_valid(dataset, "crop_type", names)
        return fill_features(encode(good, names), self.getOrDefault(self.inputs))


class TreeModel(Transformer, MLWritable, MLReadable):
    """A booster as the stage of a pipeline; its trees are saved as tables."""

    def __init__(self, booster: Booster | None = None):
        super().__init__()
        self.booster = booster

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.booster.transform(dataset)

    def write(self) -> TreeModelWriter:
        return TreeModelWriter(self)

    @classmethod
    def read(cls) -> TreeModelReader:
        return TreeModelReader()


class TreeModelWriter(MLWriter):
    def __init__(self, model: TreeModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.booster.save(self.sparkSession, f"{path}/trees")


class TreeModelReader(MLReader):
    def load(self, path: str) -> TreeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TreeModel(Booster.load(self.sparkSession, f"{path}/trees"))
        model._resetUid(metadata["uid"])
        return model


def as_pipeline(booster: Booster, classes: Sequence[str] = CROP_CLASSES) -> PipelineModel:
    """Inputs and trees as one model of requests."""
    return PipelineModel([RequestInputs(classes=classes, inputs=booster.features), TreeModel(booster)])


def save_model(booster: Booster, path: str, classes: Sequence[str] = CROP_CLASSES) -> None:
    """Write a new folder; an existing model is never replaced."""
    as_pipeline(booster, classes).save(path)


def log_trained(booster: Booster, row: DataFrame, runs: str, run_id: str, path: str, params: dict | None = None, classes: Sequence[str] = CROP_CLASSES) -> None:
    """Save the model, then log its run with the path, so that a logged path can always be loaded."""
    save_model(booster, path, classes)
    log_run(row, runs, run_id, {**(params or {}), "model_path": path})


def model_path(runs: DataFrame, run_id: str | None = None) -> str:
    """The path of a run's model, by default that of the latest run that has one (equal times: the last by run_id)."""
    paths = runs.filter((F.col("kind") == "param") & (F.col("name") == "model_path"))
    if run_id is not None:
        paths = paths.filter(F.col("run_id") == run_id)
    found = paths.orderBy(F.desc("start_time"), F.desc("run_id")).first()
    if found is None:
        raise LookupError("no such run has a saved model")
    return found["value"]


def load_model(spark: SparkSession, runs: DataFrame, run_id: str | None = None) -> PipelineModel:
    """The saved model of a run."""
    return PipelineModel.read().session(spark).load(model_path(runs, run_id))
