"""Structured Streaming jobs over the functions that also serve tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from annualis.operators.joins import unique_features
from annualis.operators.rates import event_rate, histogram_quantile, window_buckets
from annualis.operators.scoring import Model, score
from annualis.schemas import CROP_CLASSES, LATENCY_BOUNDS, SERIES_INPUTS
from annualis.sources.sinks import log_rows


def stream_rates(events: DataFrame, watermark: str = "10 minutes", width="1 minute", slide: str | None = None,
                 by: Sequence[str] = (), ts="ts") -> DataFrame:
    """``event_rate`` on a stream. In append mode a window comes out once the watermark passed its end."""
    return event_rate(events.withWatermark(ts, watermark), width, slide, by, ts)


def stream_quantiles(events: DataFrame, v: str, watermark: str = "10 minutes", width="5 minutes",
                     qs: Sequence[float] = (0.5, 0.95, 0.99), bounds: Sequence[float] = LATENCY_BOUNDS,
                     ts="ts") -> DataFrame:
    """Bucket quantiles per window of a stream; the state is one row of counters per open window."""
    return histogram_quantile(window_buckets(events.withWatermark(ts, watermark), v, width, None, bounds, (), ts), qs, bounds)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is available now and append it as Parquet; waits for the end."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def replace_batch(make: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to its own folder, ``run=<checkpoint>/batch=<id>``.

    A batch that is run again after a failure replaces its folder, so no row is
    logged twice and the log is never read back. Batches are numbered anew with each checkpoint, so the folder is
    also named by it: by the query id that Spark keeps there.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])
        make(batch).write.mode("overwrite").parquet(f"{path}/run={kept['id']}/batch={batch_id}")

    return write


def stream_score(requests: DataFrame, features: DataFrame, model: Model, log_path: str, checkpoint: str,
                 model_name: str, confidence: float, version: str | None = None, classes: Sequence[str] = CROP_CLASSES, key: str = "event_id",
                 watermark: str | None = None, ts="ts", digits: int | None = 3) -> StreamingQuery:
    """Score a stream of requests and log the requests of each batch once.

    The feature table is made unique and stored once, and joined per batch. A request that arrives again in a later batch
    is dropped by its key only with ``watermark``, which bounds the state that this needs.
    """
    if watermark:
        requests = requests.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])

    dim = features.select(F.col("area").alias("country"), "year", *SERIES_INPUTS)
    known = unique_features(dim).withColumnRenamed("country", "area")

    def make(batch: DataFrame) -> DataFrame:
        scored, _ = score(batch.dropDuplicates([key]), known, model, classes, digits, unique_features=True)
        return log_rows(scored, model_name, confidence, version, [key])

    query = (
        requests.writeStream.foreachBatch(replace_batch(make, log_path, checkpoint)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
