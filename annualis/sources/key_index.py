"""A table in parts with an index of its keys, so that a load reads only the parts that may hold a key of it.

The index has a Bloom filter for each part, all of the same number of slots, stored by slot: a row
``(slot, word, bits)`` tells which of the 64 parts of a word set the slot. A key's parts are the bits that all
its slots have in common, found by one join on the slot. A filter never misses a key and now and then names a
part too many; the keys of the named parts are then compared exactly.

The index of a load is written before its rows. A load that broke off is repeated as a whole: its slots are set
already, which costs reads and no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from annualis.operators.quality import new_rows
from annualis.session import join_same, path_exists, stored, stored_with

PROBES = 6


@dataclass(frozen=True)
class IndexedTable:
    """Where the rows, the slots and the part numbers are.

    ``part`` is the column the rows are stored by, one folder per value. ``slots`` is the length of a part's filter, best
    24 times the keys of a large part (one key in some 10,000 is then asked for in a part that lacks it); it must not
    change while the table lives. A part with more keys is asked more often than needed, and results stay exact.
    """

    path: str
    keys: tuple[str, ...]
    part: str
    slots: int = 1 << 24

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def index(self) -> str:
        return f"{self.path}/index"

    @property
    def numbers(self) -> str:
        return f"{self.path}/parts"


def _probes(table: IndexedTable) -> Column:
    """The slots of a row's key, without repeats."""
    # Shifted so that no sum passes 63 bits.
    first, step = F.shiftrightunsigned(F.xxhash64(*table.keys), 2), F.shiftrightunsigned(F.xxhash64(F.lit(1), *table.keys), 8)
    slots = [F.pmod(first + step * F.lit(i), F.lit(table.slots)) for i in range(PROBES)]
    return F.array_distinct(F.array(*slots))


def indexed_table(df: DataFrame, path: str, keys: Sequence[str], part: str) -> IndexedTable:
    """A table for data like ``df``, whose largest part sets the filters' length."""
    largest = df.groupBy(part).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    return IndexedTable(path, tuple(keys), part, 1 << max(10, (24 * largest - 1).bit_length()))


def read_rows(spark: SparkSession, table: IndexedTable) -> DataFrame:
    """The table's rows; the part column has the type it was loaded with, whatever the folder names look like."""
    kind = spark.read.parquet(table.numbers).schema["value"].dataType
    schema = StructType([StructField(f.name, kind if f.name == table.part else f.dataType) for f in spark.read.parquet(table.rows).schema])
    return spark.read.schema(schema).parquet(table.rows)


def _with_keys(table: IndexedTable, df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(table.keys))


def may_hold(spark: SparkSession, table: IndexedTable, df: DataFrame) -> DataFrame:
    """(keys, part) for each key of ``df``, all different, and each part of the table whose filter has it.

    The parts come as values of the part column. One shuffle of the slots asked for; nothing of the rows is read.
    """
    asked = _with_keys(table, df).select(*table.keys, F.explode(_probes(table)).alias("slot"), F.size(_probes(table)).alias("_n"))
    slots = spark.read.parquet(table.index).groupBy("slot", "word").agg(F.bit_or("bits").alias("bits"))
    common = asked.join(slots, "slot").groupBy(*table.keys, "word").agg(
        F.bit_and("bits").alias("_common"), F.count(F.lit(1)).alias("_found"), F.first("_n").alias("_n"))
    common = common.filter((F.col("_found") == F.col("_n")) & (F.col("_common") != 0))
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("_common", b) == 1)
    found = common.select(*table.keys, "word", F.explode(places).alias("_place"))
    found = found.select(*table.keys, (F.col("word") * 64 + F.col("_place")).alias("number"))
    return join_same(found, spark.read.parquet(table.numbers), ["number"]).select(*table.keys, F.col("value").alias("_part"))


def _number_parts(spark: SparkSession, table: IndexedTable, df: DataFrame) -> DataFrame:
    """``(number, value)`` of all parts, after numbers were given to the parts that ``df`` brings. One row per folder."""
    seen = df.select(F.col(table.part).alias("value")).distinct()
    if path_exists(spark, table.numbers):
        known = spark.read.parquet(table.numbers)
        last = known.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]
        named = known.select(F.col("value").alias("_named"))
        seen = seen.join(named, F.col("value").eqNullSafe(F.col("_named")), "left_anti")
    else:
        last = -1
    # Folder names; Spark lists all of them on the driver whenever the table is read.
    values = sorted((r["value"] for r in seen.collect()), key=lambda x: (x is not None, x))
    if values:
        kind = df.schema[table.part].dataType.simpleString()
        rows = [(last + 1 + i, x) for i, x in enumerate(values)]
        spark.createDataFrame(rows, f"number bigint, value {kind}").coalesce(1).write.mode("append").parquet(table.numbers)
    return spark.read.parquet(table.numbers)


def _add(spark: SparkSession, table: IndexedTable, df: DataFrame) -> None:
    """Append rows that are new: first their part numbers and slots, then the rows."""
    numbers = _number_parts(spark, table, df).withColumnRenamed("value", table.part)
    keyed = join_same(_with_keys(table, df), numbers, [table.part])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("number") % 64).cast("int"))
    slots = keyed.select(F.explode(_probes(table)).alias("slot"), F.floor(F.col("number") / 64).alias("word"), bit.alias("bits"))
    slots.groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).write.mode("append").parquet(table.index)
    df.hint("rebalance", F.col(table.part)).write.mode("append").partitionBy(table.part).parquet(table.rows)


def append_indexed(df: DataFrame, table: IndexedTable) -> dict[str, int]:
    """Append the rows whose key the table does not hold; gives how many rows, and how many parts were read for that.

    Equal to ``append_new``: of several rows with one key one is taken, and a key with a NULL in it is always new. One
    load at a time.
    """
    spark = df.sparkSession
    old = path_exists(spark, table.rows)
    if old:
        # Equal keys must have equal hashes, so they get the types of the table.
        held = read_rows(spark, table)
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in held.schema])
    unique, seen = stored_with(df.dropDuplicates(list(table.keys)), "load", n=F.count(F.lit(1)))
    if not old:
        _add(spark, table, unique)
        return {"added": seen["n"], "parts_read": 0}
    hits = stored(may_hold(spark, table, unique), "hits")
    # Bounded by the number of folders.
    parts = [r["_part"] for r in hits.select("_part").distinct().collect()]
    if not parts:
        _add(spark, table, unique)
        return {"added": seen["n"], "parts_read": 0}
    wanted = F.col(table.part).isin([p for p in parts if p is not None])
    if None in parts:
        wanted = wanted | F.col(table.part).isNull()
    asked = hits.select(*table.keys).distinct()
    known = held.filter(wanted).join(asked, list(table.keys), "left_semi").select(*table.keys)
    fresh, count = stored_with(new_rows(unique, known, list(table.keys)), f"fresh-{uuid.uuid4().hex[:8]}", n=F.count(F.lit(1)))
    if count["n"]:
        _add(spark, table, fresh)
    return {"added": count["n"], "parts_read": len(parts)}
