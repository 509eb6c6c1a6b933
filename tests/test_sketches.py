"""Stored quantile sketches: merged ranges, refreshed periods, NULL and NaN, groups without values."""

import math

import pytest

from annualis.operators import sketches as K


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches") / "t")
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', null) AS g", "cast(id % 6 as int) AS day", "cast((id * 7919) % 60000 as double) AS v")
    K.store_sketches(df, path, ["g"], "day", "v")
    return df, path


def _rank_off(df, value, q):
    values = sorted(r[0] for r in df.select("v").collect())
    low = sum(x < value for x in values) / len(values)
    high = sum(x <= value for x in values) / len(values)
    return max(low - q, q - high, 0)


def test_a_range_of_periods_is_merged_with_the_rank_error_of_one_sketch(spark, stored):
    df, path = stored
    found = K.sketch_quantiles(K.merged(spark, path, ["g"], "day", 1, 4), ["g"], [0.0, 0.1, 0.5, 0.9, 1.0]).collect()
    assert {(r["g"], r["n"]) for r in found} == {("hot", 10_000), (None, 30_000)}
    for g in ("hot", None):
        rows = df.filter("day between 1 and 4").filter("g = 'hot'" if g else "g is null")
        for r in found:
            if r["g"] == g:
                assert _rank_off(rows, r["value"], r["q"]) <= 2 * K.rank_error()


def test_only_the_folders_of_the_range_are_read(spark, stored):
    plan = K.merged(spark, stored[1], ["g"], "day", 2, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "v#" not in plan.split("ReadSchema")[1]


def test_a_period_loaded_again_replaces_its_sketch(spark, tmp_path):
    path = str(tmp_path / "t")
    K.store_sketches(spark.createDataFrame([(1, 5.0), (2, 7.0)], "day int, v double"), path, [], "day", "v")
    K.store_sketches(spark.createDataFrame([(2, 9.0)], "day int, v double"), path, [], "day", "v")
    assert [tuple(r) for r in K.sketch_quantiles(K.merged(spark, path, [], "day"), [], [0.0, 1.0]).collect()] == [(0.0, 5.0, 2), (1.0, 9.0, 2)]


def test_null_and_nan_do_not_count_and_groups_without_values_have_no_row(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, math.nan), ("b", 1, 3.0), ("b", 1, None)], "g string, day int, v double")
    assert [(r["g"], r["day"], r["n"]) for r in K.sketch(df, ["g"], "day", "v").collect()] == [("b", 1, 1)]
    assert K.sketch(df.limit(0), ["g"], "day", "v").count() == 0


def test_boxes_and_qq_points_from_a_sketch(spark):
    df = spark.range(2_000).selectExpr("1 AS day", "if(id < 1960, cast(id % 100 as double), 1000.0) AS v")
    one = K.sketch(df, [], "day", "v", 4_000).select("sketch", "n")
    box = K.sketch_boxes(one, []).first()
    assert abs(box["median"] - 50) <= 2 and abs(box["q1"] - 25) <= 2 and abs(box["outliers"] - 40) <= 4
    points = K.sketch_qq(one, 9).orderBy("theoretical").collect()
    assert len(points) == 9 and points[4]["theoretical"] == pytest.approx(0) and points[0]["ordered"] <= points[8]["ordered"]
