"""Jump consistent hashing: rows to shards without a table of ring positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annualis.session import stored_with

STEP = np.uint64(2862933555777941757)  # the multiplier of the published generator
RUN_ROWS = 200_000  # rows that one task numbers


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: follow its jumps until one lands beyond the last shard."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    live, here = np.arange(len(state)), np.full(len(state), -1, np.int64)
    to = np.zeros(len(state), np.int64)
    while live.size:
        at[live] = to
        state = state * STEP + np.uint64(1)
        here = at[live] + 1
        to = np.floor(here * (2.0**31 / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        on = to < shards
        live, state, to = live[on], state[on], to[on]
    return at.astype(np.int32)


def shard_of(key, shards: int):
    """Column with the shard of a long column."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return run(key)


def jump_key(df: DataFrame, columns: list[str]):
    """One whole-number column is its own key (null: 0); anything else is hashed to 64 bits."""
    kinds = dict(df.dtypes)
    if len(columns) == 1 and kinds[columns[0]] in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(f"`{columns[0]}`").cast("bigint"), F.lit(0).cast("bigint"))
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def assign_shards(df: DataFrame, keys: list[str], shards: int, order: list[str]) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (gapless from 0 in a shard, in ``order``) and ``grown_shard``.

    The shard depends on the key and the number of shards alone; ``grown_shard`` is the one with
    a shard more, either the same or the new one. Give narrow rows: they are stored and shuffled once.
    Slots are numbered in runs of about ``RUN_ROWS`` rows of a shard, so a shard of any size is spread
    over tasks, and so are the rows of one key; rows that tie in the key and in all of ``order`` come in any order. Null keys count as 0
    (hashed keys: as Spark hashes null), an empty table stays empty, repeated rows get a slot each.
    Columns of ``df`` named shard, slot or grown_shard are replaced.
    """
    given = [c for c in df.columns if c not in ("shard", "slot", "grown_shard")]
    key = jump_key(df, keys)
    data = df.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"), key.alias("key"),
                     shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"))
    kept, seen = stored_with(data, "sharded", n=F.count(F.lit(1)))
    runs = max(1, -(-int(seen["n"] or 0) // (RUN_ROWS * shards)))
    kept = kept.withColumn("run", F.pmod(F.xxhash64("key", *[f"row.`{c}`" for c in order]), F.lit(runs)))
    by_shard = Window.partitionBy("shard").orderBy("run")
    before = (kept.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "run", (F.sum("n").over(by_shard) - F.col("n")).alias("before")))
    in_run = Window.partitionBy("shard", "run").orderBy("key", *[f"row.`{c}`" for c in order])
    return (kept.join(before, ["shard", "run"])
            .withColumn("slot", F.col("before") + F.row_number().over(in_run) - 1)
            .select("row.*", "shard", "slot", "grown_shard"))


def write_shards(df: DataFrame, keys: list[str], shards: int, path: str) -> None:
    """Write whole rows into one folder per shard; large shards get several files."""
    key = jump_key(df, keys)
    (df.withColumn("shard", shard_of(key, shards)).hint("rebalance", "shard")
     .write.mode("overwrite").partitionBy("shard").parquet(path))


def document_shards(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return assign_shards(rows, ["doc_id"], shards, ["doc_id", "size", "text_crc32"])
