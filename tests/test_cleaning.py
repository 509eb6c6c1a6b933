import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annualis.functions import scalar as X
from annualis.operators import cleaning as C
from annualis.operators import quality as Q
from annualis.schemas import CROP_CLASSES


def test_clean_series_drops_bad_rows(spark, rows):
    raw = spark.createDataFrame(
        [("France", "2001", "1.5"), ("France", "20o1", "1"), ("France", "2002", "NaN"), ("France", "2003", "-1"),
         (None, "2004", "1"), ("France", "2005", None), ("France", "2006", "0"), ("France", "2007", "abc")],
        "Area string, Year string, Value string")
    out = C.clean_series(raw)
    assert out.dtypes == [("area", "string"), ("year", "int"), ("value_tonnes", "double")]
    assert rows(out) == [("France", 2001, 1.5), ("France", 2006, 0.0)]


def test_split_valid_gives_a_reason(spark):
    df = spark.createDataFrame([("corn",), ("banana",), (None,)], "crop_type string")
    good, bad = C.split_valid(df, "crop_type", CROP_CLASSES)
    assert [r.crop_type for r in good.collect()] == ["corn"]
    assert {r._reason for r in bad.collect()} == {"unknown crop_type"} and bad.count() == 2


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "2.5"), (None, "2"), ("x", "1"), ("2", "y")], "a string, b string")
    wanted = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    good, bad = C.enforce_schema(df, wanted)
    assert [tuple(r) for r in good.collect()] == [(1, 2.5)]
    assert sorted(r._reason for r in bad.collect()) == ["a: missing", "a: not int", "b: not double"]
    lacking, _ = C.enforce_schema(df.drop("b"), wanted)
    assert lacking.count() == 0


def test_json_fields(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("nope",), ('{"k": "x"}',), (None,)], "props string")
    out = C.parse_json_fields(df, "props", T.StructType([T.StructField("k", T.LongType())]))
    assert [(r.k, r._malformed) for r in out.collect()] == [(3, False), (None, True), (None, True), (None, True)]


def test_fill_replaces_nan_and_null(spark, rows):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 4.0)], "i int, x double")
    assert rows(C.fill_features(df, ["x"])) == [(1, 0.0), (2, 0.0), (3, 4.0)]


def test_select_existing_and_limit():
    assert C.check_limit(500) == 500
    for wrong in (501, -1):
        with pytest.raises(ValueError):
            C.check_limit(wrong)


def test_select_existing(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert C.select_existing(df, ["a", "zzz", "b"]).columns == ["a", "b"]


def test_lookups(spark, rows):
    df = spark.createDataFrame([("F", 2000, 1.0, None, 2.0, 0.5), ("F", 2000, 1.0, None, 2.0, 0.5)],
                               "area string, year int, value_tonnes double, yoy_growth_pct double, ma5_tonnes double, value_normalized double")
    assert C.lookup_features(df, "F", 2000).count() == 1
    assert C.lookup_features(df, "F", 2001).count() == 0
    assert C.by_id(spark.range(3), 7).count() == 0 and C.by_id(spark.range(3), 1).count() == 1


def test_key_checks(spark, rows):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2), (None, 3)], "k string, y int")
    assert rows(Q.check_unique(df, ["k", "y"])) == [("A", 1, 2)]
    dim = spark.createDataFrame([("A",)], "k string")
    assert rows(Q.check_fk(df, dim, "k")) == [("B", 1)]
    assert rows(Q.new_rows(df, dim, ["k"])) == [(None, 3), ("B", 2)]


def test_quality_flags(spark):
    row = Q.quality_flags(spark.createDataFrame([(0.9, 0.8, -0.01)], "r2 double, rmse double, bias double")).first()
    assert (row.r2_flag, row.rmse_flag, row.bias_flag) == ("good", "warn", "good")


# --- scalar functions ----------------------------------------------------------


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_guards(spark):
    assert value(spark, X.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert value(spark, X.safe_div(F.lit(1.0), F.lit(0.0), F.lit(1.0))) == 1.0
    assert value(spark, X.clamp_min(F.lit(None).cast("double"), 0.1)) is None
    assert value(spark, X.clamp_min(F.lit(-5.0), 0.1)) == 0.1


def test_round_arith(spark):
    assert [value(spark, X.round_arith(F.lit(x), 2)) for x in (1.125, -1.125, 0.0)] == [1.13, -1.13, 0.0]


def test_keys_and_labels(spark):
    assert value(spark, X.sanitize_key(F.lit("China, mainland/x"))) == "China_mainland_x"
    assert value(spark, X.metric_key(F.lit("China, main/x"))) == "China_main/x"
    assert value(spark, X.entity_label(F.lit(3), F.lit("n"), F.lit(None), F.lit("France"))) == "3 — n (, France)"
    assert value(spark, X.short_name(F.lit("China, mainland"))) == "China"
    assert value(spark, X.capitalised(F.lit("sunFlower"))) == "Sunflower"


def test_dates(spark):
    assert str(value(spark, X.mid_season(F.lit(2012)))) == "2012-07-01"
    assert [str(d) for d in value(spark, X.year_starts(F.lit(2017), 3))] == ["2017-01-01", "2018-01-01", "2019-01-01"]
    assert value(spark, X.iso_date(X.jan_first(F.lit(1999)))) == "1999-01-01"
    assert value(spark, X.parse_iso_date(F.lit("soon"))) is None


def test_class_codes(spark):
    codes = [value(spark, X.encode_class(F.lit(c), CROP_CLASSES)) for c in ("corn", "rice", "soybean", "sunflower", "wheat", "banana")]
    assert codes == [0, 1, 2, 3, 4, None]


def test_normal_quantile(spark):
    from statistics import NormalDist

    ps = [1e-300, 1e-12, 0.01, 0.07, 0.075, 0.3, 0.5, 0.9, 0.999, 1 - 1e-12]
    df = X.with_normal_quantile(spark.createDataFrame([(p,) for p in ps], "p double"), F.col("p"), "z")
    for r in df.collect():
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-12)
    edge = X.with_normal_quantile(spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "p double"), F.col("p"), "z")
    assert [r.z for r in edge.collect()] == [None] * 3


def test_hashed_noise_is_standard_normal_and_ignores_partitioning(spark):
    df = spark.range(20000).withColumn("z", X.hashed_normal("id", 42))
    row = df.agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(row.m) < 0.03 and abs(row.s - 1) < 0.03
    again = spark.range(0, 20000, 1, 13).withColumn("z", X.hashed_normal("id", 42))
    assert df.join(again, ["id", "z"]).count() == 20000


def test_hashed_choice(spark):
    out = {r.c: r["count"] for r in spark.range(9000).groupBy(X.hashed_choice("id", 7, ["a", "b", "c"]).alias("c")).count().collect()}
    assert set(out) == {"a", "b", "c"} and min(out.values()) > 2800
