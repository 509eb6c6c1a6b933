"""Compare a query with its SQL: row count, column types and values, in any order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _norm(x):
    if x is None:
        return "~"
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
          "TIMESTAMP": "timestamp", "BOOLEAN": "boolean", "FLOAT": "float"}


def compare(df, con, sql: str) -> list[str]:
    """Differences found, empty if the two agree."""
    rel = con.sql(sql)
    ours = {n: t.replace("timestamp_ntz", "timestamp") for n, t in df.dtypes}
    theirs = {n: _KINDS.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    problems = []
    if ours != theirs:
        problems.append(f"columns {sorted(ours.items() - theirs.items())} vs {sorted(theirs.items() - ours.items())}")
        if set(ours) != set(theirs):
            return problems
    names = sorted(ours)
    left = sorted(tuple(_norm(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    right = sorted(tuple(_norm(v) for v in row) for row in rel.project(", ".join(f'"{n}"' for n in names)).fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    extra, missing = set(left) - set(right), set(right) - set(left)
    if left != right:
        problems.append(f"{len(extra)} rows only ours, {len(missing)} only theirs; {names}: {sorted(extra)[:2]} / {sorted(missing)[:2]}")
    return problems
