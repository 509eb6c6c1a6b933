"""Key checks, idempotent append, quality gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.schemas import GATES


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count. Counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_fk(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values of ``df`` that ``dim`` lacks, with the number of rows that carry them.

    Rows collapse to one per key before the anti join, so a hot key costs nothing.
    """
    dim_key = dim_key or key
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_known"))
    return counts.join(known, F.col(key) == F.col("_known"), "left_anti")


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose natural key the target does not hold yet.

    The target side is reduced to distinct keys first.
    """
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti")


def quality_flags(metrics: DataFrame, gates: Mapping[str, float] = GATES) -> DataFrame:
    """``good`` or ``warn`` for each gated column that ``metrics`` has.

    R2 must be above its gate; RMSE, absolute bias and fold spread below theirs.
    """
    def passed(name: str, gate: float):
        if name == "r2":
            return F.col(name) > gate
        return (F.abs(F.col(name)) if name == "bias" else F.col(name)) < gate

    present = {n: g for n, g in gates.items() if n in metrics.columns}
    return metrics.withColumns(
        {f"{n}_flag": F.when(passed(n, g), F.lit("good")).otherwise(F.lit("warn")) for n, g in present.items()}
    )
