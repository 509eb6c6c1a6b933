"""Reading tables and files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annualis.functions.scalar import sanitize_key
from annualis.schemas import FORECAST, RAW_SERIES


def read_series_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SERIES) -> DataFrame:
    """Delimited text with a header; every column is text, nothing is inferred.

    Columns are matched by position against ``schema``; a header that disagrees is an error.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """A Parquet file or a directory partitioned by column; partition values come from the path.

    ``merge_schema`` unites the columns of files written before and after a column was added.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def jdbc_options(url: str, table_or_query: str, user: str, password: str, driver: str = "org.postgresql.Driver",
                 partition: tuple[str, object, object, int] | None = None, fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read; ``partition`` is (column, lower, upper, number of parallel reads).

    A query is wrapped as a derived table, because a partitioned read takes no ``query``.
    """
    text = table_or_query.strip()
    table = f"({text}) AS q" if text.lower().startswith(("select", "with")) else text
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
               "fetchsize": str(fetch_rows)}
    if partition:
        column, lower, upper, n = partition
        options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(n)}
    return options


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, user: str, password: str, **how) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table_or_query, user, password, **how)).load()


def read_forecast(spark: SparkSession, path: str, area: str | None = None) -> DataFrame:
    """Forecast documents; with ``area`` those of that entity, from its folder only. Empty means none was made.

    Entities whose names differ in replaced characters alone share a folder, so the name is compared too.
    """
    docs = spark.read.schema(T.StructType([*FORECAST.fields, T.StructField("area_key", T.StringType())])).json(path)
    if area is None:
        return docs
    return docs.filter((F.col("area_key") == sanitize_key(F.lit(area))) & (F.col("area") == area))


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tables from before and after a column was added; the column is NULL in the old rows."""
    return old.unionByName(new, allowMissingColumns=True)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet files as a stream; ``ts`` without zone becomes a timestamp, as watermarks need one.

    The path is passed as a pattern that matches itself: a stream takes a bare path
    for a directory, a pattern may name a file or a directory.
    """
    pattern = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema).options(**(options or {})).parquet(pattern)
    ntz = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else stream
