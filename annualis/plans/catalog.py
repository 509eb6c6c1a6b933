"""Registry of queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL where there is one."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def sql_round(expr: str, digits: int) -> str:
    """SQL form of ``functions.scalar.round_arith``."""
    return f"(sign({expr}) * floor(abs({expr}) * 1e{digits} + 0.5e0) / 1e{digits})"
