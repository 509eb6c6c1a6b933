"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_base: dict[str, str] = {}
_scope: ContextVar[str] = ContextVar("scope", default="")


def build_session(app: str = "annualis", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE, skew joins and UTC; further settings by ``conf`` with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("_", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _local_base:
        _local_base[context.applicationId] = tempfile.mkdtemp(prefix="annualis-")
    return _local_base[context.applicationId]


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/annualis-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; inside ``scratch_scope`` one that goes with it."""
    return f"{_application_dir(spark)}/{_scope.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end; use or write the results before that.

    Scopes may nest. A thread started inside has no part in the scope.
    """
    folder = f"{_scope.get()}scope-{uuid.uuid4().hex}/"
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        files, place = file_system(spark, f"{_application_dir(spark)}/{folder}")
        files.delete(place, True)


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables this application stored; call it when their readers are done."""
    files, place = file_system(spark, _application_dir(spark))
    files.delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Model fits cut their lineage with checkpoints; they need the folder to be set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs no recomputation, fixes values
    that depend on task placement, and gives the planner the true size in bytes: a
    join with the result is broadcast when, and only when, it is under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it is a sort-merge join
    with AQE skew handling.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stored`` together with aggregates over the rows, taken while they are written."""
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    out = stored(df.observe(seen, *[e.alias(n) for n, e in measures.items()]), label)
    return out, seen.get


BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20  # as Parquet
HOT_ROWS = 1_000_000  # rows of one key that a task may get


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hint=lambda df: df) -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the key columns are those of ``left``."""
    named = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(hint(named), same, how).drop(*[f"_k_{k}" for k in keys])


def stored_bytes(df: DataFrame) -> int:
    """Size of a stored table as the planner knows it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def attach(df: DataFrame, per_key: DataFrame, keys: list[str], label: str, how: str = "inner") -> DataFrame:
    """Join a computed table, one or a few rows per key, to rows among which keys may be hot.

    The table is stored and its rows are counted on the way; see ``join_counted``.
    """
    small, seen = stored_with(per_key, label, n=F.count(F.lit(1)))
    return join_counted(df, small, seen["n"], keys, how)


def join_counted(df: DataFrame, small: DataFrame, n: int, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a stored table of ``n`` rows: by broadcast while it is within ``BROADCAST_ROWS`` and ``BROADCAST_BYTES``.

    Beyond, the rows of each key are counted. A key with more than ``HOT_ROWS`` of them is spread by the partition its rows
    come from, which a retried task keeps, and only its rows of the table are copied; all others are joined once. NULL
    keys are equal. A right or full join would repeat the copies' unmatched rows and is refused.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"{how} join of a table that may be copied")
    if n <= BROADCAST_ROWS and stored_bytes(small) <= BROADCAST_BYTES:
        return join_same(df, small, keys, how, F.broadcast)
    salts = F.ceil(F.col("count") / HOT_ROWS).cast("int")
    hot = stored(df.groupBy(*keys).count().filter(F.col("count") > HOT_ROWS).select(*keys, salts.alias("_salts")), "hot-keys")
    spread = join_same(df.withColumn("_from", F.spark_partition_id()), hot, keys, "left")
    spread = spread.withColumn("_salt", F.coalesce(F.pmod("_from", "_salts"), F.lit(0))).drop("_from", "_salts")
    copies = join_same(small, hot, keys, "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return join_same(spread, copies, [*keys, "_salt"], how).drop("_salt")
