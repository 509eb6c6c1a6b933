import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from annualis.operators import rates as R
from annualis.operators.scoring import response_score
from annualis.schemas import LATENCY_BOUNDS
from annualis.session import scratch_path
from annualis.sources.readers import stream_table
from annualis.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def events(spark):
    rows = [(i, at(m), kind, v) for i, (m, kind, v) in enumerate([
        (0.5, "500", 0.002), (0.7, "200", 0.02), (3.2, "503", 0.3), (3.9, "200", 9.0), (12.0, "200", 0.002)])]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, code string, seconds double")


def test_rate_per_minute(events):
    out = {r.window_start: (r.n, r.per_minute, r.per_second) for r in R.event_rate(events, "1 minute").collect()}
    assert out == {at(0): (2, 2.0, 2 / 60), at(3): (2, 2.0, 2 / 60), at(12): (1, 1.0, 1 / 60)}


def test_sliding_windows_equal_sparks_own(events, rows):
    ours = R.event_rate(events, "4 minutes", "2 minutes", ["code"]).select("window_start", "window_end", "code", "n")
    spark_own = events.groupBy(F.window("ts", "4 minutes", "2 minutes").alias("w"), "code").count().select("w.start", "w.end", "code", "count")
    assert rows(ours) == rows(spark_own)


def test_uneven_slide_is_exact_too(events, rows):
    ours = R.event_rate(events, "5 minutes", "2 minutes").select("window_start", "n")
    assert rows(ours) == rows(events.groupBy(F.window("ts", "5 minutes", "2 minutes").alias("w")).count().select("w.start", "count"))


def test_matching_events_in_a_trailing_window(events):
    out = {r.window_end: r.n for r in R.matching_increase(events, "code", "^5..$").collect()}
    assert len(out) == 17 and out[at(1)] == 1 and out[at(4)] == 2 and out[at(6)] == 1 and out[at(10)] == 0 and out[at(13)] == 0
    with pytest.raises(ValueError):
        R.matching_increase(events, "code", "5", 90, 60)


def test_bucket_quantiles(spark, events):
    wide = R.bucket_counts(events, "seconds")
    row = wide.first()
    assert (row.le_0_001, row.le_0_005, row.le_2_5, row.n) == (0, 2, 4, 5)
    q = R.histogram_quantile(wide, (0.2, 0.5, 0.99)).first()
    assert q.p20 == pytest.approx(0.001 + 0.004 * 0.5)
    assert q.p50 == pytest.approx(0.01 + 0.015 * 0.5)
    assert q.p99 == LATENCY_BOUNDS[-1]
    none = R.histogram_quantile(R.bucket_counts(events.filter("false"), "seconds")).first()
    assert (none.n, none.p50) == (0, None)


def test_first_bucket_starts_at_zero(spark):
    df = spark.createDataFrame([(0.0005,)] * 4, "v double")
    assert R.histogram_quantile(R.bucket_counts(df, "v"), (0.5,)).first().p50 == pytest.approx(0.0005)


# --- streams --------------------------------------------------------------------------


def write_part(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_stream_drops_rows_behind_the_watermark(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "event_id bigint, ts timestamp_ntz, kind string"

    def run():
        stream = stream_table(spark, src, spark.createDataFrame([], schema).schema, {"maxFilesPerTrigger": "1"})
        jobs.run_to_table(jobs.stream_rates(stream, "10 minutes", "10 minutes", by=["kind"]), out, str(tmp_path / "state"))

    write_part(spark.createDataFrame([(1, at(1), "a"), (2, at(5), "a"), (3, at(45), "a")], schema), src)
    run()
    write_part(spark.createDataFrame([(4, at(2), "a"), (5, at(44), "a"), (6, at(90), "a")], schema), src)
    run()
    got = {r.window_start: r.n for r in spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert got == {at(0): 2, at(40): 2}  # minute 2 came too late, minute 90 is still open


def requests(spark, ids, crop="corn"):
    rows = [(i, at(i), 10 + i, crop if i % 4 else "banana", 2010, "France", 0.4, 6.5, 100.0, 20.0, 60.0, 500.0, 180.0) for i in ids]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, parcel_id bigint, crop_type string, year int, country string, "
                                 "soil_moisture double, soil_ph double, nitrogen_ppm double, air_temp_c double, humidity_pct double, "
                                 "rainfall_mm double, solar_rad_wm2 double")


def test_stream_scoring_logs_each_request_once(spark, tmp_path):
    src, log, state = (str(tmp_path / n) for n in ("src", "log", "state"))
    features = spark.createDataFrame([("France", 2010, 5.0, 1.0, 5.0, 0.5)] * 2,
                                     "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    model = lambda df: response_score(df, name="prediction", digits=None)

    def run():
        stream = stream_table(spark, src, requests(spark, [1]).schema)
        jobs.stream_score(stream, features, model, log, state, "trees", 0.75, version="3", watermark="1 hour")

    write_part(requests(spark, [1, 2, 3, 4, 4, 5]), src)
    run()
    write_part(requests(spark, [5, 6, 7]), src)  # request 5 comes again
    run()
    run()
    out = spark.read.parquet(log).collect()
    assert sorted(r.event_id for r in out) == [1, 2, 3, 5, 6, 7]
    assert {r.model_version for r in out} == {"3"} and {r.irrigation_rec_mm for r in out} == {150.0}
    (run_folder,) = [d for d in os.listdir(log) if d.startswith("run=")]
    assert os.path.isdir(f"{log}/{run_folder}/batch=0")


def test_a_new_checkpoint_keeps_the_old_log(spark, tmp_path):
    """Batches are numbered anew, and are other batches."""
    src, log = str(tmp_path / "src"), str(tmp_path / "log")
    features = spark.createDataFrame([("France", 2010, 5.0, 1.0, 5.0, 0.5)],
                                     "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    model = lambda df: response_score(df, name="prediction", digits=None)
    for k, ids in enumerate(([1, 2, 3, 5, 6], [7, 9])):
        write_part(requests(spark, ids), f"{src}{k}")
        jobs.stream_score(stream_table(spark, f"{src}{k}", requests(spark, [1]).schema), features, model, log, str(tmp_path / f"state{k}"), "trees", 0.75)
    assert sorted(r.event_id for r in spark.read.parquet(log).collect()) == [1, 2, 3, 5, 6, 7, 9]


def test_a_repeated_batch_replaces_its_rows(spark):
    path, state = scratch_path(spark, "log"), scratch_path(spark, "state")
    spark.createDataFrame([('{"id":"abc"}',)], "value string").coalesce(1).write.text(state + "/metadata")
    write = jobs.replace_batch(lambda df: df, path, state)
    for _ in range(2):
        write(spark.range(3), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(path).count() == 5
