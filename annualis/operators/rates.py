"""Event counts, rates, bucket histograms and their quantiles over time windows.

The same functions serve tables and streams: they are group-bys on
``F.window``, whose counts combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.schemas import LATENCY_BOUNDS


def counter_total(events: DataFrame, label: str, name: str = "total") -> DataFrame:
    return events.groupBy(label).agg(F.count(F.lit(1)).alias(name))


def grand_total(events: DataFrame, name: str = "total") -> DataFrame:
    """Number of events, 0 when there are none."""
    return events.agg(F.count(F.lit(1)).alias(name))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(interval: str) -> int | None:
    number, _, unit = interval.strip().partition(" ")
    size = _UNIT_SECONDS.get(unit.strip().lower().rstrip("s"))
    return int(number) * size if size and number.isdigit() else None


def _windowed(events: DataFrame, ts: str, width: str, slide: str | None, by: Sequence[str],
              counts: dict[str, Column]) -> DataFrame:
    """Counts per window and label.

    On a table with sliding windows, rows are counted per slide step first and only the
    counts are copied into the windows that overlap; a row is never multiplied.
    """
    sums = [e.alias(n) for n, e in counts.items()]
    wide, step = _seconds(width), _seconds(slide) if slide else None
    if not slide:
        out = events.groupBy(F.window(ts, width).alias("_w"), *by).agg(*sums)
    elif events.isStreaming or not wide or not step or wide % step:
        out = events.groupBy(F.window(ts, width, slide).alias("_w"), *by).agg(*sums)
    else:
        steps = events.groupBy(F.window(ts, slide).alias("_s"), *by).agg(*sums)
        steps = steps.select(F.col("_s.start").alias("_at"), *by, *counts)
        out = steps.groupBy(F.window("_at", width, slide).alias("_w"), *by).agg(*[F.sum(n).alias(n) for n in counts])
    return out.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, *counts)


def _span_seconds(start="window_start", end="window_end") -> Column:
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return (micros(end) - micros(start)) / F.lit(1e6)


def event_rate(events: DataFrame, width="1 minute", slide: str | None = None, by: Sequence[str] = (),
               ts="ts") -> DataFrame:
    """Events per window and label: count, rate per second and per minute. Windows without events are absent."""
    out = _windowed(events, ts, width, slide, by, {"n": F.count(F.lit(1))})
    return out.withColumns({
        "per_second": F.col("n") / _span_seconds(), "per_minute": F.col("n") * F.lit(60.0) / _span_seconds(),
    })


def matching_increase(events: DataFrame, label: str, pattern: str, width_s: int = 300, slide_s: int = 60,
                      ts="ts") -> DataFrame:
    """Events whose label matches ``pattern`` in the ``width_s`` seconds before each ``slide_s`` step, 0 if none.

    Steps run from the first event to the last. Events are counted per step first; only
    the counts are copied into the windows they belong to.
    """
    if width_s % slide_s:
        raise ValueError("the width must be a multiple of the slide")
    steps = width_s // slide_s
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    step = F.floor(micros / F.lit(slide_s * 1e6)).cast("bigint")
    slots = events.select(step.alias("slot"), F.col(label).rlike(pattern).cast("int").alias("hit"))
    counts = slots.groupBy("slot").agg(F.sum("hit").alias("n"))
    # the window that starts at slot s covers the slots s .. s + steps - 1
    spread = counts.select(F.explode(F.sequence(F.col("slot") - (steps - 1), F.col("slot"))).alias("slot"), "n")
    day = max(86400 // slide_s, 1)  # the axis is generated in chunks of a day, which are dealt to all tasks before they are filled
    ends = slots.agg((F.min("slot") - (steps - 1)).alias("a"), F.max("slot").alias("b"))
    chunks = ends.select("b", F.explode(F.sequence("a", "b", F.lit(day).cast("bigint"))).alias("c")).repartition("c")
    axis = chunks.select(
        F.explode(F.sequence("c", F.least(F.col("c") + (day - 1), F.col("b")))).alias("slot"), F.lit(0).alias("n"))
    total = axis.unionByName(spread).groupBy("slot").agg(F.sum("n").cast("bigint").alias("n"))
    at = lambda c: F.timestamp_micros(c * F.lit(slide_s * 1_000_000)).cast("timestamp_ntz")
    return total.select(
        at(F.col("slot")).alias("window_start"), at(F.col("slot") + steps).alias("window_end"), "n")


def bucket_name(bound: float) -> str:
    return "le_" + f"{bound:g}".replace(".", "_")


def bucket_counts(events: DataFrame, v: str, bounds: Sequence[float] = LATENCY_BOUNDS, by: Sequence = ()) -> DataFrame:
    """Cumulative counts ``v <= bound`` per bound, and the count of all values, in one pass."""
    return events.groupBy(*by).agg(*[e.alias(n) for n, e in _bucket_sums(v, bounds).items()])


def _bucket_sums(v: str, bounds: Sequence[float]) -> dict[str, Column]:
    x = F.col(v)
    return {**{bucket_name(b): F.count_if(x <= F.lit(float(b))) for b in bounds}, "n": F.count(x)}


def window_buckets(events: DataFrame, v: str, width="5 minutes", slide: str | None = None,
                   bounds: Sequence[float] = LATENCY_BOUNDS, by: Sequence[str] = (), ts="ts") -> DataFrame:
    """``bucket_counts`` per time window."""
    return _windowed(events, ts, width, slide, by, _bucket_sums(v, bounds))


def quantile_expr(q: float, bounds: Sequence[float] = LATENCY_BOUNDS) -> Column:
    """Quantile by linear interpolation in its bucket, from ``bucket_counts`` columns.

    The first bucket starts at 0. A quantile above the last finite bound gives that
    bound; no observations give NULL.
    """
    rank = F.lit(float(q)) * F.col("n")
    low, below = F.lit(0.0), F.lit(0)
    out = None
    for bound in bounds:
        upto, high = F.col(bucket_name(bound)), F.lit(float(bound))
        inside = low + (high - low) * ((rank - below) / F.when(upto > below, upto - below))
        inside = F.coalesce(inside, high)
        hit = (F.col("n") > 0) & (upto >= rank)
        out = F.when(hit, inside) if out is None else out.when(hit, inside)
        low, below = high, upto
    return out.when(F.col("n") > 0, low)


def histogram_quantile(buckets: DataFrame, qs: Sequence[float] = (0.5, 0.95, 0.99),
                       bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Add ``p50``-style columns to a table of bucket counts and drop the buckets."""
    keep = [c for c in buckets.columns if not c.startswith("le_")]
    return buckets.select(*keep, *[quantile_expr(q, bounds).alias(f"p{q * 100:g}".replace(".", "_")) for q in qs])
