"""Row order inside groups of any size.

``row_number`` or ``lag`` over ``PARTITION BY key`` puts a whole group into one
task. The functions here spread each group over the cluster: rows are range
partitioned by (key, order), the position inside a task's sorted run is taken, and
the number of rows of the same key in earlier runs is added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.session import stored

_RUN_BITS = 33  # monotonically_increasing_id keeps the partition above 33 row bits


def ordered_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
                 partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by ``order``.

    ``order`` should end in a unique column. One range shuffle of the rows; the run
    table holds one row per key and run, at most #keys + #partitions, and its window
    sees at most #partitions rows per key.
    """
    keys, order = list(keys), list(order)
    by = [*keys, *order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    runs = stored(
        ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_run", F.shiftright("_at", _RUN_BITS)),
        "ranked",
    )
    per_run = runs.groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        per_run.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "runs"
    )
    offsets = offsets.select("_first", "_before", F.col("_run").alias("_r"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    same = F.col("_run") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = runs.join(offsets, same)
    position = (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    return joined.select(*df.columns, position.alias(name))


def over_blocks(df: DataFrame, keys: Sequence[str], rank: str, reach: int,
                columns: Mapping[str, "callable"], block_rows: int = 100_000) -> DataFrame:
    """Add columns computed over a window of the last ``reach`` rows, in groups of any size.

    ``columns`` maps a name to a function of the ordered window. Each group is cut
    into blocks of ``block_rows`` consecutive ranks; the last ``reach`` rows of a block
    are copied to the next one as context and dropped after the window ran.
    """
    if reach >= block_rows:
        raise ValueError("reach must be smaller than a block")
    block = F.floor((F.col(rank) - 1) / F.lit(float(block_rows))).cast("bigint")
    place = (F.col(rank) - 1) % block_rows
    targets = F.when(place >= block_rows - reach, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("_own", block).withColumn("_block", F.explode(targets))
    window = Window.partitionBy(*keys, "_block").orderBy(rank)
    out = spread.withColumns({name: make(window) for name, make in columns.items()})
    return out.filter(F.col("_block") == F.col("_own")).drop("_own", "_block")


def over_ranges(df: DataFrame, keys: Sequence[str], ord: str, reach: int,
                columns: Mapping[str, "callable"], span: int = 10_000) -> DataFrame:
    """Add columns over windows of order values, ``rangeBetween(-reach, 0)`` or less, in groups of any length.

    ``ord`` is a whole number and (keys, ord) is unique. A group is cut where ``ord`` passes a multiple of ``span``; rows
    within ``reach`` of the next cut are copied over it as context and dropped afterwards. So a window holds at most
    ``span + reach`` rows. Rows without an order value are a block of their own.
    """
    if reach >= span:
        raise ValueError("reach must be smaller than a span")
    at = F.col(ord).cast("bigint")
    place = F.pmod(at, F.lit(span))
    block = (at - place) / span  # whole, and exact as a double far beyond any count of periods
    block = block.cast("bigint")
    targets = F.when(place >= span - reach, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("_own", block).withColumn("_block", F.explode(targets))
    window = Window.partitionBy(*keys, "_block").orderBy(ord)
    out = spread.withColumns({name: make(window) for name, make in columns.items()})
    return out.filter(F.col("_block").eqNullSafe(F.col("_own"))).drop("_own", "_block")


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``, as a plain aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    best = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
