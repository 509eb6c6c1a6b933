"""Queries of cleaning, key checks, scalar functions and row lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from annualis.functions import scalar as X
from annualis.operators import cleaning as C
from annualis.operators import quality as Q
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.schemas import COUNTRY_CLIMATE, CROP_CLASSES, CROP_COLORS, DEFAULT_COLOR


def dirty_series(spark, sf):
    """Events as raw text rows: missing names, bad years, NaN and negative values."""
    i, value = F.col("event_id"), F.col("value").cast("string")
    return V.events(spark, sf).select(
        F.lit("Events").alias("Domain"),
        F.when(i % 11 != 0, F.col("event_type")).alias("Area"),
        F.lit("Use").alias("Element"), F.lit("All, total").alias("Item"),
        F.when(i % 10 == 0, F.lit("n/a")).otherwise((F.lit(1990) + i % 27).cast("string")).alias("Year"),
        F.lit("tonnes").alias("Unit"),
        F.when(i % 13 == 0, F.lit("NaN")).when(i % 17 == 0, F.concat(F.lit("-1"), value)).when(
            i % 19 == 0, F.lit("unknown")).otherwise(value).alias("Value"),
    )


DIRTY = """dirty AS (
  SELECT CASE WHEN event_id % 11 <> 0 THEN event_type END AS area,
    CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(1990 + event_id % 27 AS VARCHAR) END AS year,
    CASE WHEN event_id % 13 = 0 THEN 'NaN' WHEN event_id % 17 = 0 THEN '-1' || CAST(value AS VARCHAR)
      WHEN event_id % 19 = 0 THEN 'unknown' ELSE CAST(value AS VARCHAR) END AS value
  FROM events)"""
CLEAN = f"""{DIRTY}, typed AS (SELECT area, TRY_CAST(year AS INTEGER) AS year, TRY_CAST(value AS DOUBLE) AS value_tonnes FROM dirty),
clean AS (SELECT area, CAST(year AS BIGINT) AS year, value_tonnes FROM typed
  WHERE area IS NOT NULL AND year IS NOT NULL AND value_tonnes IS NOT NULL AND NOT isnan(value_tonnes) AND value_tonnes >= 0)"""


@query(f"WITH {CLEAN} SELECT area, year, value_tonnes FROM clean")
def clean_cast(spark, sf):
    return C.clean_series(dirty_series(spark, sf)).withColumn("year", F.col("year").cast("bigint"))


@query(f"""WITH {V.PARCELS}, {V.REQUESTS} SELECT event_id, parcel_id, crop_type,
  CASE WHEN crop_type NOT IN ('corn', 'rice', 'soybean', 'sunflower', 'wheat') THEN 'unknown crop_type' END AS reason
FROM requests""")
def clean_rejects(spark, sf):
    requests = V.requests(spark, sf).select("event_id", "parcel_id", "crop_type")
    good, rejects = C.split_valid(requests, "crop_type", CROP_CLASSES)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.withColumnRenamed("_reason", "reason"))


@query("""WITH t AS (SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS parcel_id,
  CASE WHEN event_id % 9 = 0 THEN 'twenty' ELSE CAST(value AS VARCHAR) END AS rainfall_mm FROM events),
c AS (SELECT event_id, TRY_CAST(parcel_id AS BIGINT) AS parcel_id, TRY_CAST(rainfall_mm AS DOUBLE) AS rainfall_mm FROM t)
SELECT event_id, parcel_id, rainfall_mm, CASE WHEN parcel_id IS NULL THEN 'parcel_id: missing'
  WHEN rainfall_mm IS NULL THEN 'rainfall_mm: not double' END AS reason FROM c""")
def enforce_schema(spark, sf):
    i = F.col("event_id")
    text = V.events(spark, sf).select(
        "event_id", F.when(i % 7 != 0, F.col("user_id").cast("string")).alias("parcel_id"),
        F.when(i % 9 == 0, F.lit("twenty")).otherwise(F.col("value").cast("string")).alias("rainfall_mm"))
    wanted = T.StructType([T.StructField("parcel_id", T.LongType()), T.StructField("rainfall_mm", T.DoubleType())])
    return C.flag_schema(text, wanted).withColumnRenamed("_reason", "reason")


@query("""SELECT event_id, CASE WHEN event_id % 8 <> 0 THEN CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT) END AS k,
  event_id % 8 = 0 AS malformed FROM events""")
def parse_json(spark, sf):
    broken = V.events(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 8 == 0, F.concat(F.lit("oops"), "props")).otherwise(F.col("props")).alias("props"))
    out = C.parse_json_fields(broken, "props", T.StructType([T.StructField("k", T.LongType())]))
    return out.select("event_id", "k", F.col("_malformed").alias("malformed"))


@query(f"""WITH {V.FEATURES_CTE} SELECT area, CAST(year AS BIGINT) AS year, coalesce(yoy_growth_pct, 0e0) AS yoy_growth_pct,
  coalesce(cagr_5y_pct, -1e0) AS cagr_5y_pct FROM features""")
def default_nulls(spark, sf):
    wide = V.features(spark, sf).select("area", F.col("year").cast("bigint").alias("year"), "yoy_growth_pct", "cagr_5y_pct")
    return C.default_nulls(wide, {"yoy_growth_pct": 0.0, "cagr_5y_pct": -1.0})


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 6 = 0 THEN 0e0 ELSE value END AS value FROM events""")
def fill_features(spark, sf):
    i = F.col("event_id")
    holed = V.events(spark, sf).select(
        "event_id", F.when(i % 5 == 0, F.lit(float("nan"))).when(i % 6 != 0, F.col("value")).alias("value"))
    return C.fill_features(holed, ["value"])


@query(f"""WITH {V.CUSTOMER_SERIES} SELECT area, CAST(year AS BIGINT) AS year, value_tonnes FROM customer_series
WHERE year BETWEEN 1996 AND 1999""")
def between_years(spark, sf):
    return C.between_years(V.customer_series(spark, sf), 1996, 1999).withColumn("year", F.col("year").cast("bigint"))


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf):
    return Q.check_unique(V.table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


@query("""SELECT o_orderkey, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
GROUP BY 1""")
def check_fk(spark, sf):
    return Q.check_fk(V.table(spark, sf, "orders"), V.table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@query(f"""WITH {V.CUSTOMER_SERIES} SELECT area, CAST(year AS BIGINT) AS year, value_tonnes FROM customer_series
WHERE (area, year) NOT IN (SELECT o_custkey, year(o_orderdate) FROM orders WHERE o_orderpriority = '1-URGENT')""")
def append_new(spark, sf):
    urgent = V.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("area"), F.year("o_orderdate").alias("year"))
    out = Q.new_rows(V.customer_series(spark, sf), urgent, ["area", "year"])
    return out.withColumn("year", F.col("year").cast("bigint"))


@query(f"""WITH {V.PARCELS} SELECT u AS id, p.name, p.crop_type, p.id IS NOT NULL AS found
FROM (SELECT DISTINCT l_orderkey AS u FROM lineitem) LEFT JOIN parcels p ON p.id = u""")
def entity_lookup(spark, sf):
    wanted = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    known = V.parcels(spark, sf).select("id", "name", "crop_type", F.lit(True).alias("_hit"))
    return wanted.join(known, "id", "left").select("id", "name", "crop_type", F.col("_hit").isNotNull().alias("found"))


@query(f"""SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') AS jan1,
  make_date(year(o_orderdate), 7, 1) AS mid, {sql_round('sqrt(o_totalprice)', 4)} AS root, {sql_round('ln(1e0 + o_totalprice)', 4)} AS log,
  greatest(o_totalprice - 250000e0, 0e0) AS above, left(o_orderpriority, 8) AS prefix,
  upper(left(o_orderstatus || o_orderpriority, 1)) || lower(substring(o_orderstatus || o_orderpriority, 2)) AS cap,
  epoch_ms(CAST(o_orderkey * 1000 AS BIGINT)) AS at_ms FROM orders""")
def scalar_functions(spark, sf):
    p, day = F.col("o_totalprice"), F.col("o_orderdate")
    both = F.concat("o_orderstatus", "o_orderpriority")
    return V.table(spark, sf, "orders").select(
        "o_orderkey", F.year(day).cast("bigint").alias("y"), X.iso_date(X.jan_first(F.year(day))).alias("jan1"),
        X.mid_season(F.year(day)).alias("mid"), X.round_arith(F.sqrt(p), 4).alias("root"),
        X.round_arith(F.log1p(p), 4).alias("log"), X.clamp_min(p - F.lit(250000.0), 0.0).alias("above"),
        X.short_name("o_orderpriority", 8).alias("prefix"), X.capitalised(both).alias("cap"),
        X.millis_to_timestamp(F.col("o_orderkey") * 1000).cast("timestamp_ntz").alias("at_ms"))


@query(f"""WITH {V.PARCELS}
SELECT id, id || ' — ' || name || ' (' || crop_type || ', ' || country || ')' AS label,
  replace(replace(replace(name || ', a/b', ' ', '_'), ',', ''), '/', '_') AS safe_key,
  CASE crop_type {' '.join(f"WHEN '{c}' THEN '{v}'" for c, v in CROP_COLORS.items() if c != 'rice')} ELSE '{DEFAULT_COLOR}' END AS colour,
  CASE crop_type WHEN 'corn' THEN 0 WHEN 'rice' THEN 1 WHEN 'soybean' THEN 2 WHEN 'sunflower' THEN 3 WHEN 'wheat' THEN 4 END AS code
FROM parcels""")
def label_functions(spark, sf):
    some = {c: v for c, v in CROP_COLORS.items() if c != "rice"}
    return V.parcels(spark, sf).select(
        "id", X.entity_label("id", "name", "crop_type", "country").alias("label"),
        X.sanitize_key(F.concat("name", F.lit(", a/b"))).alias("safe_key"),
        X.map_lookup("crop_type", some, DEFAULT_COLOR).alias("colour"),
        X.encode_class("crop_type", CROP_CLASSES).alias("code"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_discount / l_tax END AS ratio,
  CASE WHEN l_tax <> 0 THEN l_discount / l_tax ELSE 1e0 END AS ratio_or_one FROM lineitem""")
def guarded_division(spark, sf):
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.safe_div("l_discount", "l_tax").alias("ratio"),
        X.safe_div("l_discount", "l_tax", F.lit(1.0)).alias("ratio_or_one"))


@query(f"""WITH p AS (SELECT c_custkey, CASE c_nationkey % 3 {' '.join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate(['France', 'Japan', 'Atlantis']))} END AS country FROM customer)
SELECT c_custkey, country, CASE country WHEN 'France' THEN 11e0 WHEN 'Japan' THEN 13e0 END AS temp,
  CASE country WHEN 'France' THEN 650e0 WHEN 'Japan' THEN 1700e0 ELSE 600e0 END AS rain FROM p""")
def climate_lookup(spark, sf):
    names = {0: "France", 1: "Japan", 2: "Atlantis"}
    named = V.table(spark, sf, "customer").select("c_custkey", X.map_lookup(F.col("c_nationkey") % 3, names).alias("country"))
    return named.withColumns({
        "temp": X.map_lookup("country", {c: v[2] for c, v in COUNTRY_CLIMATE.items()}),
        "rain": X.map_lookup("country", {c: v[3] for c, v in COUNTRY_CLIMATE.items()}, 600.0)})


@query("""SELECT event_id, event_type = 'error' AS late, CASE WHEN event_type = 'error' THEN props END AS note FROM events""")
def schema_evolution(spark, sf):
    from annualis.sources.readers import union_evolved

    late = F.col("event_type") == "error"
    old = V.events(spark, sf).filter(~late).select("event_id", F.lit(False).alias("late"))
    new = V.events(spark, sf).filter(late).select("event_id", F.lit(True).alias("late"), F.col("props").alias("note"))
    return union_evolved(old, new)
