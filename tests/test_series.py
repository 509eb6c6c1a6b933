import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from annualis.operators import series as S
from annualis.operators.ordered import ordered_rank, over_blocks

COLS = "area string, year int, value_tonnes double"


def frame(spark, values, area="A", first=2000):
    return spark.createDataFrame([(area, first + i, float(v)) for i, v in enumerate(values)], COLS)


def by_year(df, column):
    return [r[column] for r in df.orderBy("year").collect()]


def test_growth_needs_a_previous_value_that_is_not_zero(spark):
    assert by_year(S.growth(frame(spark, [10, 0, 5, 6])), "yoy_growth_pct") == [None, -100.0, None, 20.0]


def test_moving_mean_uses_the_rows_there_are(spark):
    assert by_year(S.moving_avg(frame(spark, [1, 2, 3, 4, 5, 6])), "ma5_tonnes") == [1.0, 1.5, 2.0, 2.5, 3.0, 4.0]


def test_cagr_needs_a_positive_base_and_gives_minus_100_for_zero(spark):
    out = by_year(S.cagr(frame(spark, [1, 0, 2, 2, 2, 32, 7, 0])), "cagr_5y_pct")
    assert out == [None] * 5 + [100.0, None, -100.0]


def test_flat_series_normalises_to_zero(spark):
    assert by_year(S.minmax(frame(spark, [3, 3, 3])), "value_normalized") == [0.0, 0.0, 0.0]
    assert by_year(S.minmax(frame(spark, [3, 3, 3]), any_size=True), "value_normalized") == [0.0, 0.0, 0.0]


def test_versus_period_mean(spark):
    both = frame(spark, [10, 0], "A").unionByName(frame(spark, [30, 0], "B"))
    out = {(r.area, r.year): r.pct_vs_global_avg for r in S.vs_period_avg(both).collect()}
    assert out == {("A", 2000): -50.0, ("B", 2000): 50.0, ("A", 2001): None, ("B", 2001): None}


def test_features_are_by_row_and_calendar_features_by_period(spark):
    gap = spark.createDataFrame([("A", 2000, 10.0), ("A", 2003, 20.0), ("A", 2004, 30.0)], COLS)
    assert by_year(S.series_features(gap), "yoy_growth_pct") == [None, 100.0, 50.0]
    out = S.calendar_features(gap)
    assert by_year(out, "yoy_growth_pct") == [None, None, 50.0]
    assert by_year(out, "ma5_tonnes") == [10.0, 15.0, 20.0]
    assert by_year(S.densify(gap), "value_tonnes") == [10.0, None, None, 20.0, 30.0]


def test_features_keep_every_row_and_other_columns(spark):
    df = frame(spark, range(8)).withColumn("note", F.lit("x"))
    out = S.series_features(df)
    assert out.count() == 8 and out.columns[-1] == "note"


def test_stats_take_the_first_peak_and_the_last_known_growth(spark):
    df = spark.createDataFrame(
        [("A", 2000, 5.0, None), ("A", 2001, 9.0, 80.0), ("A", 2002, 9.0, 0.0), ("A", 2003, 1.0, None)],
        COLS + ", yoy_growth_pct double")
    row = S.series_stats(df).first()
    assert (row.total, row.peak, row.peak_period, row.last_value, row.last_period, row.last_growth) == (
        24.0, 9.0, 2001, 1.0, 2003, 0.0)


def test_future_starts_after_each_entitys_own_last_period(spark):
    both = frame(spark, [1, 2], "A").unionByName(frame(spark, [1], "B", 2010))
    out = {(r.area, r.year) for r in S.future_spine(both, horizon=2).collect()}
    assert out == {("A", 2002), ("A", 2003), ("B", 2011), ("B", 2012)}


def test_top_entities_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("C", 1, 5.0), ("B", 1, 5.0), ("A", 1, 1.0)], COLS)
    assert [r.area for r in S.top_entities(df, 1).collect()] == ["B"]


def test_first_entities_in_list_order(spark):
    df = spark.createDataFrame([("C", 1, 5.0), ("A", 1, 5.0), ("B", 1, 1.0), ("A", 2, 1.0)], COLS)
    assert sorted(r.area for r in S.first_entities(df, 2).collect()) == ["A", "A", "B"]


# --- groups of any size ----------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows, order values repeat, one key is NULL."""
    rng = np.random.default_rng(5)
    n = 6000
    key = np.where(np.arange(n) < 4000, "hot", rng.choice(["a", "b", None], n))
    pdf = pd.DataFrame({"k": key, "t": rng.integers(0, 50, n), "id": rng.permutation(n), "v": rng.integers(1, 99, n).astype(float)})
    return pdf, spark.createDataFrame(pdf, "k string, t bigint, id bigint, v double").repartition(5).cache()


def test_rank_equals_row_number(skewed):
    pdf, df = skewed
    got = ordered_rank(df, ["k"], ["t", "id"], "rank", partitions=7).toPandas()
    want = pdf.sort_values(["t", "id"])
    want["rank"] = want.groupby("k", dropna=False).cumcount() + 1
    merged = got.merge(want[["id", "rank"]], on="id", suffixes=("", "_want"))
    assert len(got) == len(pdf) and (merged["rank"] == merged["rank_want"]).all()


def test_rank_without_keys_is_global(skewed):
    pdf, df = skewed
    got = ordered_rank(df, [], ["t", "id"], "rank", partitions=7).toPandas().sort_values(["t", "id"])
    assert got["rank"].tolist() == list(range(1, len(pdf) + 1))


def test_hot_key_is_spread_over_runs(skewed, spark):
    _, df = skewed
    out = ordered_rank(df, ["k"], ["t", "id"], "rank", partitions=6)
    blocks = over_blocks(out, ["k"], "rank", 5, {"_p": lambda w: F.count("v").over(w)}, block_rows=500)
    assert blocks.filter("k = 'hot'").agg(F.max("_p")).first()[0] <= 505


@pytest.mark.parametrize("block_rows", [7, 64, 100_000])
def test_long_features_equal_pandas(skewed, block_rows):
    pdf, df = skewed
    known = df.filter("k is not null")
    got = S.long_series_features(known, "k", ["t", "id"], "v", block_rows=block_rows, partitions=6).toPandas().set_index("id")
    want = pdf.dropna(subset=["k"]).sort_values(["k", "t", "id"])
    g = want.groupby("k")["v"]
    want["growth"] = (want["v"] / g.shift(1) - 1) * 100
    want["ma"] = g.transform(lambda s: s.rolling(5, min_periods=1).mean())
    want["cagr"] = ((want["v"] / g.shift(5)) ** 0.2 - 1) * 100
    want["norm"] = (want["v"] - g.transform("min")) / (g.transform("max") - g.transform("min"))
    want = want.set_index("id").loc[got.index]
    assert len(got) == len(want)
    for ours, theirs, tol in (("growth_pct", "growth", 0.006), ("ma5", "ma", 0.006), ("cagr_5_pct", "cagr", 0.006),
                              ("normalized", "norm", 0.00006)):
        assert (got[ours].isna() == want[theirs].isna()).all()
        assert np.nanmax(np.abs(got[ours] - want[theirs])) <= tol


def test_calendar_features_of_long_entities_equal_those_in_one_window(spark, rows):
    hot = spark.range(3_000).selectExpr("if(id % 3 = 0, 'hot', concat('e', id % 7)) AS area",
                                        "cast((id * 37) % 1009 - 500 as int) AS year", "cast((id * 31) % 97 as double) AS value_tonnes", "id")
    more = spark.createDataFrame([("hot", 7, None, -1), ("hot", None, 5.0, -2), (None, 7, 2.0, -3), (None, 8, 4.0, -4)],
                                 "area string, year int, value_tonnes double, id long")
    df = hot.union(more)
    for span in (6, 64, 10_000):
        assert rows(S.long_calendar_features(df, span=span)) == rows(S.calendar_features(df))
    with pytest.raises(ValueError):
        S.long_calendar_features(df, span=5)
    assert S.long_calendar_features(df.limit(0)).count() == 0
