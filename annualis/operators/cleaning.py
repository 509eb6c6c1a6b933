"""Typed columns out of text, NULL handling, filters and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_series(df: DataFrame, area="Area", year="Year", value="Value") -> DataFrame:
    """Text columns to ``(area, year, value_tonnes)``.

    Bad text becomes NULL, rows with a NULL or NaN key or value go, then rows below
    zero. The NaN test comes first because NaN >= 0 is true in Spark. The value is a
    64-bit double, not a 32-bit float.
    """
    typed = df.select(
        F.col(area).alias("area"),
        F.col(year).try_cast(T.IntegerType()).alias("year"),
        F.col(value).try_cast(T.DoubleType()).alias("value_tonnes"),
    )
    return typed.dropna(subset=["area", "year", "value_tonnes"]).filter(F.col("value_tonnes") >= 0)


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column], name: str = "_reason") -> DataFrame:
    """Add the first rule each row breaks, NULL for good rows; a rule is the condition to hold."""
    reasons = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()]
    return df.withColumn(name, F.coalesce(*reasons))


def split_valid(df: DataFrame, column: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose class is allowed, and the others with a ``_reason``."""
    flagged = with_reject_reason(df, {f"unknown {column}": F.col(column).isin(list(allowed))})
    return flagged.filter(F.col("_reason").isNull()).drop("_reason"), flagged.filter(F.col("_reason").isNotNull())


def flag_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each field of ``schema`` tolerantly and name the first missing or ill-typed one."""
    checks: list[Column] = []
    fields: list[Column] = []
    for field in schema.fields:
        if field.name not in df.columns:
            checks.append(F.lit(f"{field.name}: missing"))
            fields.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(field.name)
        typed = raw.try_cast(field.dataType)
        checks.append(F.when(raw.isNull(), F.lit(f"{field.name}: missing")))
        checks.append(F.when(typed.isNull(), F.lit(f"{field.name}: not {field.dataType.simpleString()}")))
        fields.append(typed.alias(field.name))
    others = [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*fields, *others, F.coalesce(*checks).alias("_reason"))


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that carry every field of ``schema`` with its type, and the rejects with ``_reason``."""
    flagged = flag_schema(df, schema)
    good = flagged.filter(F.col("_reason").isNull()).drop("_reason")
    return good, flagged.filter(F.col("_reason").isNotNull())


def parse_json_fields(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Fields of a JSON text column as columns; ``_malformed`` is true where it does not parse.

    A field of the wrong type or a document that is no object counts as malformed.
    """
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(column), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    wide = df.withColumn("_json", parsed)
    fields = [F.col(f"_json.{f.name}").alias(f.name) for f in schema.fields]
    bad = F.col("_json").isNull() | F.col("_json._corrupt_record").isNotNull()
    return wide.select(*df.columns, *fields, bad.alias("_malformed"))


def between_years(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    """Years from ``first`` to ``last`` inclusive; prunes folders of a table stored by year."""
    return df.filter(F.col(column).between(first, last))


def by_id(df: DataFrame, value, column: str = "id") -> DataFrame:
    """The row with this id; an empty result means not found."""
    return df.filter(F.col(column) == F.lit(value))


def lookup_features(df: DataFrame, area: str, year: int) -> DataFrame:
    """The feature row of one entity and year, at most one."""
    wanted = df.filter((F.col("area") == area) & (F.col("year") == year))
    return wanted.select("value_tonnes", "yoy_growth_pct", "ma5_tonnes", "value_normalized").limit(1)


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """COALESCE per column; NaN stays."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fill_features(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Replace NULL and NaN by ``value`` in the feature columns."""
    return df.fillna(value, subset=list(columns))


def split_by_time(df: DataFrame, column: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including ``cutoff``, and the rows after it."""
    return df.filter(F.col(column) <= cutoff), df.filter(F.col(column) > cutoff)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])


def check_limit(limit: int, most: int = 500) -> int:
    if not 0 <= limit <= most:
        raise ValueError(f"limit must be from 0 to {most}, not {limit}")
    return limit
