"""Run records: versions, the latest run, the best run per metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.operators.ordered import ordered_rank


def run_versions(runs: DataFrame, experiment="experiment", start="start_time", tie="run_id",
                 partitions: int | None = None) -> DataFrame:
    """Version = position by start time in the experiment; works for experiments of any size."""
    return ordered_rank(runs, [experiment], [start, tie], "version", partitions)


def latest_run(runs: DataFrame, experiment="experiment", start="start_time", tie="run_id") -> DataFrame:
    """The most recent run per experiment."""
    rest = [c for c in runs.columns if c != experiment]
    row = F.max_by(F.struct(*rest), F.struct(start, tie)).alias("_run")
    return runs.groupBy(experiment).agg(row).select(experiment, "_run.*")


def best_run(runs: DataFrame, by: Sequence[str] = (), version="version", lower: Sequence[str] = ("rmse", "mae"),
             higher: Sequence[str] = ("r2",)) -> DataFrame:
    """Version and value of the best run per metric; the first one on ties, NULL metrics ignored."""
    def best(metric: str, high: bool) -> list[Column]:
        v = F.col(metric)
        order = F.when(v.isNotNull(), F.struct(-v if high else v, F.col(version)))
        return [F.min_by(version, order).alias(f"best_{metric}_version"),
                (F.max(v) if high else F.min(v)).alias(f"best_{metric}")]

    aggregates = [e for m in lower for e in best(m, False)] + [e for m in higher for e in best(m, True)]
    return runs.groupBy(*by).agg(*aggregates)


def pivot_runs(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Long run table ``(run_id, start_time, name, value)`` to one row per run with a column per metric."""
    return long.groupBy("run_id", "start_time").agg(
        *[F.max(F.when(F.col("name") == m, F.col("value"))).alias(m) for m in metrics])
