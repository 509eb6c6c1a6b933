"""The alert series of a stream is that of the table on closed windows, zeros included, whatever the batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from annualis.operators.rates import matching_increase
from annualis.streaming import alerts

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Bursts with gaps of several windows; files in the order of time."""
    minutes = [*range(0, 12), 13, 13, 40, 41, 41, 90, 95, 96, *range(180, 200), 260]
    rows = [(START + dt.timedelta(minutes=m, seconds=7 * k % 60), ("error", "view", None)[k % 3]) for k, m in enumerate(minutes)]
    path = str(tmp_path_factory.mktemp("events") / "e")
    for a in range(0, len(rows), 9):
        spark.createDataFrame(rows[a:a + 9], "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(path)
    return path


def test_closed_windows_with_zeros(spark, events, tmp_path):
    table = spark.read.parquet(events)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(events)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    alerts.run_increase(alerts.stream_increase(stream, "kind", "^err", watermark="2 minutes"), out, state)
    closed = table.agg(F.max("ts") - F.expr("INTERVAL 2 MINUTES")).first()[0]
    want = matching_increase(table, "kind", "^err").filter(F.col("window_end") <= F.lit(closed).cast("timestamp_ntz"))
    rows = lambda df: sorted((r["window_start"], r["window_end"], r["n"]) for r in df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "n").collect())
    found = rows(spark.read.parquet(out))
    assert found == rows(want) and len(found) > 200 and sum(n == 0 for *_, n in found) > 100
    alerts.run_increase(alerts.stream_increase(stream, "kind", "^err", watermark="2 minutes"), out, state)  # nothing is left to do
    assert rows(spark.read.parquet(out)) == found


def test_width_must_be_whole_steps(spark):
    with pytest.raises(ValueError):
        alerts.stream_increase(spark.range(1), "kind", "x", 100, 60)
