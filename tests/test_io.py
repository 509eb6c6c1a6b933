import os

import pytest
from pyspark.sql import functions as F

from annualis import session
from annualis.operators import cleaning as C
from annualis.sources import readers, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_to_partitioned_table(spark, tmp_path, rows):
    raw, clean = str(tmp_path / "raw.csv"), str(tmp_path / "clean")
    with open(raw, "w") as f:
        f.write("Domain,Area,Element,Item,Year,Unit,Value\nP,\"China, mainland\",Use,All,1990,t,10.5\nP,France,Use,All,19x0,t,1\n"
                "P,France,Use,All,1991,t,-2\nP,France,Use,All,1991,t,2\nP,,Use,All,1991,t,2\n")
    text = readers.read_series_csv(spark, raw)
    assert {t for _, t in text.dtypes} == {"string"} and text.count() == 5
    assert sinks.write_partitioned(C.clean_series(text), clean, "year", ["area"]) == 2
    assert sorted(d for d in os.listdir(clean) if "=" in d) == ["year=1990", "year=1991"]
    out = readers.read_table(spark, clean)
    assert rows(out, "area", "year", "value_tonnes") == [("China, mainland", 1990, 10.5), ("France", 1991, 2.0)]
    one = C.between_years(out, 1991, 1992).select("value_tonnes")
    assert "PartitionFilters: [isnotnull(year" in plan(one) and "ReadSchema: struct<value_tonnes:double>" in plan(one)


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    raw = str(tmp_path / "raw.csv")
    with open(raw, "w") as f:
        f.write("a,b,c,d,e,f,g\n1,2,3,4,5,6,7\n")
    with pytest.raises(Exception, match="header|CSV"):
        readers.read_series_csv(spark, raw).collect()


def test_partial_overwrite_keeps_other_years(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "v int, year int")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(spark.createDataFrame([(9, 2001)], "v int, year int"), path, only_present=True)
    assert rows(spark.read.parquet(path), "v", "year") == [(1, 2000), (9, 2001)]
    sinks.write_partitioned(spark.createDataFrame([(7, 1999)], "v int, year int"), path)
    assert rows(spark.read.parquet(path), "v", "year") == [(7, 1999)]


def test_a_big_year_is_split_over_tasks(spark, tmp_path):
    """Two thirds of the rows fall into one year; AQE cuts it into several files."""
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        df = spark.range(0, 30000, 1, 8).select("id", F.rand(1).alias("x"), F.when(F.col("id") < 20000, 2000).otherwise(2001).alias("year"))
        path = str(tmp_path / "t")
        sinks.write_partitioned(df, path)
        files = [f for f in os.listdir(path + "/year=2000") if f.endswith(".parquet")]
        assert len(files) > 3 and spark.read.parquet(path).count() == 30000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        sinks.append_new(df, path, ["k"])
    sinks.append_new(spark.createDataFrame([(2, "z"), (3, "c")], "k int, v string"), path, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_forecast_documents(spark, tmp_path):
    path, whole = str(tmp_path / "f"), str(tmp_path / "all")
    df = spark.createDataFrame([("China, mainland", "2017-01-01", 1.0, 0.5, 1.5), ("A/B", "2017-01-01", 2.0, 1.5, 2.5)],
                               "area string, ds string, yhat double, yhat_lower double, yhat_upper double")
    sinks.write_forecast_json(df, path, whole)
    assert os.path.isdir(path + "/area_key=China_mainland")
    found = readers.read_forecast(spark, path, "China, mainland")
    assert [r.yhat for r in found.collect()] == [1.0] and "PartitionFilters: [isnotnull(area_key" in plan(found)
    assert readers.read_forecast(spark, path, "Peru").count() == 0
    assert spark.read.json(whole).count() == 2


def test_prediction_log(spark, tmp_path):
    path = str(tmp_path / "log")
    scored = spark.createDataFrame([(1, 2.5, 10.0)], "parcel_id int, predicted_yield double, irrigation_rec_mm double")
    sinks.log_predictions(scored, path, "trees", 0.75)
    sinks.log_predictions(scored, path, "trees", 0.75, "4")
    out = spark.read.parquet(path).orderBy("model_version").collect()
    assert [(r.model_name, r.model_version, r.confidence) for r in out] == [("trees", "4", 0.75), ("trees", "unknown", 0.75)]
    assert out[0].predicted_at is not None


def test_run_log_round_trip(spark, tmp_path):
    from annualis.operators.runs import pivot_runs

    path = str(tmp_path / "runs")
    for i, rmse in enumerate((0.7, 0.6)):
        sinks.log_run(spark.createDataFrame([(rmse, 5)], "rmse double, n int"), path, f"r{i}", {"depth": 6})
    long = spark.read.parquet(path)
    assert long.count() == 6
    assert {(r.run_id, r.rmse, r.depth) for r in pivot_runs(long, ["rmse", "depth"]).collect()} == {("r0", "0.7", "6"), ("r1", "0.6", "6")}


def test_jdbc_options():
    o = sinks.jdbc_write_options("jdbc:postgresql://h/db", "t", "u", "p", connections=4)
    assert (o["truncate"], o["dbtable"], o["numPartitions"], o["driver"]) == ("true", "t", "4", "org.postgresql.Driver")
    q = readers.jdbc_options("jdbc:x", "SELECT a FROM b", "u", "p", partition=("id", 0, 100, 8))
    assert q["dbtable"] == "(SELECT a FROM b) AS q"
    assert (q["partitionColumn"], q["lowerBound"], q["upperBound"], q["numPartitions"]) == ("id", "0", "100", "8")
    assert readers.jdbc_options("jdbc:x", "parcels", "u", "p")["dbtable"] == "parcels"


def test_evolved_schema(spark, tmp_path, rows):
    old, new = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(2, "F")], "id int, country string")
    assert rows(readers.union_evolved(old, new)) == [(1, None), (2, "F")]
    path = str(tmp_path / "t")
    sinks.append(old, path)
    sinks.append(new, path)
    assert rows(readers.read_table(spark, path, merge_schema=True), "id", "country") == [(1, None), (2, "F")]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", None) or session.shared_dir(spark)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(session.shared_dir(spark))


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://cluster:7077", "app"

        def getConf(self):
            return Conf()

    class Fake:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_clear_scratch_removes_only_what_this_application_stored(spark):
    df = session.stored(spark.range(3))
    folder = session.scratch_path(spark, "x").rsplit("/", 1)[0]
    assert df.count() == 3 and os.path.isdir(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder) and os.path.isdir(session.shared_dir(spark))


def test_entities_that_share_a_folder_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([("A B", "2020-01-01", 1.0, 0.0, 2.0), ("A/B", "2020-01-01", 5.0, 0.0, 9.0)], "area string, ds string, yhat double, yhat_lower double, yhat_upper double")
    sinks.write_forecast_json(df, path)
    assert [r.yhat for r in readers.read_forecast(spark, path, "A B").collect()] == [1.0]


def test_scoped_tables_go_with_their_scope(spark):
    with session.scratch_scope(spark):
        outer = session.scratch_path(spark, "a")
        session.stored(spark.range(3), "x")
        with session.scratch_scope(spark):
            inner = session.stored(spark.range(2), "y")
            place = inner.inputFiles()[0]
            assert inner.count() == 2
        assert not session.path_exists(spark, place)
        assert outer.startswith(session.shared_dir(spark))
    assert not session.path_exists(spark, outer.rpartition("/")[0])
    kept = session.stored(spark.range(4), "z")
    assert kept.count() == 4
