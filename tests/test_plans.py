"""Shapes of physical plans: shuffles, joins, pushed filters."""

import re

from pyspark.sql import functions as F

from annualis.operators import joins as J
from annualis.operators import series as S
from annualis.plans import q_joins
from annualis.plans import views as V
from annualis.session import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|single|Single|round)", plan(df)))


def test_all_five_features_take_one_shuffle(spark, sf_dir):
    text = plan(S.series_features(V.stored_series(spark, sf_dir)))
    assert text.count("Exchange hashpartitioning(area") == 1
    assert "hashpartitioning(year" not in text and "BroadcastHashJoin" in text


def test_entity_filter_reaches_the_scan(spark, sf_dir):
    df = S.growth(V.stored_series(spark, sf_dir)).filter(F.col("area") == "NATION_3")
    assert "EqualTo(area,NATION_3)" in plan(df)


def test_stored_small_side_is_broadcast_and_large_is_not(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 7)
    small = stored(big.groupBy("k").count())
    assert "BroadcastHashJoin" in plan(big.join(small, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan(big.join(small, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_readings_are_shuffled_by_one_join(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = stored(V.order_facts(spark, sf_dir))
        readings = stored(V.readings(spark, sf_dir, facts))
        out = J.training_set(readings, V.parcels(spark, sf_dir), V.outcomes(spark, sf_dir, facts), V.features(spark, sf_dir))
        shuffles = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
        top = plan(out).split("SortMergeJoin")[1]
        assert "parcel_id" in top.splitlines()[0] and len(shuffles) <= 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_read_with_the_needed_columns_only(spark, sf_dir):
    text = plan(V.order_facts(spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in text
    assert text.count("partial_sum") >= 1


def test_no_python_and_no_cartesian_product_in_the_training_set(spark, sf_dir):
    text = plan(q_joins.training(spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
