"""Writing tables, logs and forecast documents."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from annualis.functions.scalar import sanitize_key
from annualis.operators.quality import new_rows
from annualis.session import path_exists


def write_partitioned(df: DataFrame, path: str, by: str = "year", sort: Sequence[str] = (),
                      only_present: bool = False) -> int:
    """Overwrite a Parquet table with one folder per value of ``by``; returns the rows written.

    Rows are gathered by value so that not every task writes every folder; AQE splits
    a value that is too big for one task and joins small ones. ``sort`` orders rows
    inside the files. ``only_present`` replaces only the folders ``df`` has rows for.
    """
    df = df.hint("rebalance", F.col(by))
    if sort:
        df = df.sortWithinPartitions(by, *sort)
    mode = "dynamic" if only_present else "static"
    counted, seen = with_row_count(df)
    counted.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(by).parquet(path)
    return seen.get["n"]


def with_row_count(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while it is written; read ``observation.get['n']`` afterwards.

    Use it last before the write: behind a further shuffle a stage that runs again after
    a lost executor would count its rows again.
    """
    seen = Observation(name or f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def jdbc_write_options(url: str, table: str, user: str, password: str, driver: str = "org.postgresql.Driver",
                       batch_rows: int = 10_000, connections: int | None = None) -> dict[str, str]:
    """Options of an overwrite that truncates, so the target keeps its definition and indexes."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
               "truncate": "true", "batchsize": str(batch_rows)}
    if connections:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, **how) -> None:
    options = jdbc_write_options(url, table, user, password, **how)
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose key the table does not hold; the table may not exist yet."""
    unique = df.dropDuplicates(list(keys))
    held = path_exists(df.sparkSession, path)
    append(new_rows(unique, df.sparkSession.read.parquet(path), keys) if held else unique, path)


def log_rows(scored: DataFrame, model_name: str, confidence: float, version: str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """Scored rows in the form of the prediction log; the version is ``unknown`` if not given."""
    return scored.select(
        *keep,
        F.col("parcel_id").cast("bigint").alias("parcel_id"), F.current_timestamp().alias("predicted_at"),
        F.lit(model_name).alias("model_name"), F.lit(version or "unknown").alias("model_version"),
        "predicted_yield", "irrigation_rec_mm", F.lit(confidence).alias("confidence"),
    )


def log_predictions(scored: DataFrame, path: str, model_name: str, confidence: float, version: str | None = None) -> None:
    append(log_rows(scored, model_name, confidence, version), path)


def write_forecast_json(forecast: DataFrame, path: str, consolidated: str | None = None) -> None:
    """Forecast rows as JSON, one folder per entity key, and all of them under ``consolidated``."""
    keyed = forecast.withColumn("area_key", sanitize_key("area"))
    keyed.repartition("area_key").sortWithinPartitions("area_key", "ds").write.mode("overwrite").partitionBy(
        "area_key").json(path)
    if consolidated:
        forecast.write.mode("overwrite").json(consolidated)


def run_rows(metrics: DataFrame, run_id: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """One-row metrics table and parameters as ``(run_id, start_time, kind, name, value)``."""
    names = metrics.columns
    wide = metrics.select(*[F.col(c).cast("string").alias(c) for c in names])
    parts = [F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("value")) for c in names]
    parts += [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("name"), F.lit(str(v)).alias("value"))
              for k, v in (params or {}).items()]
    return wide.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("start_time"),
                       F.inline(F.array(*parts)))


def log_run(metrics: DataFrame, path: str, run_id: str, params: Mapping[str, object] | None = None) -> None:
    append(run_rows(metrics, run_id, params), path)
