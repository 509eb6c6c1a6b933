"""Alert series on a stream: how often something happened before each step, zeros included.

Events are counted by step first; each step's count leaves that aggregation once it is closed. The counts go to a stateful operator that keeps
the steps of open windows and a timer for the next window, so that windows without events come out too when the watermark passes their end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from annualis.streaming.jobs import run_to_table

WINDOWS = "window_start timestamp, window_end timestamp, n long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
AT_ONCE = 10_000  # windows in one frame


class IncreaseProcessor(StatefulProcessor):
    """Counts of steps to windows of ``steps`` of them; a window comes out once, when the watermark has reached its end."""

    def __init__(self, steps: int, slide_s: int):
        self.steps, self.slide_s = steps, slide_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "slot long", "n long")
        self.next = handle.getValueState("next", "slot long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            for slot, n in zip(frame["slot"].tolist(), frame["hit"].tolist()):
                self.counts.updateValue((int(slot),), (int(n),))
                first = slot if first is None else min(first, slot)
        if first is not None and not self.next.exists():
            self.next.update((int(first) - self.steps + 1,))
        yield from self._closed(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._closed(timerValues)

    def _count(self, slot: int) -> int:
        return self.counts.getValue((slot,))[0] if self.counts.containsKey((slot,)) else 0

    def _closed(self, timerValues) -> Iterator[pd.DataFrame]:
        """Windows that end at the watermark or before it; then a timer for the next one."""
        if not self.next.exists():
            return
        slot = self.next.get()[0]
        until = timerValues.getCurrentWatermarkInMs() // (1000 * self.slide_s) - self.steps  # the last window that is closed
        own = [self._count(k) for k in range(slot, slot + self.steps)] if slot <= until else []
        total, rows, begun = sum(own), [], slot
        while slot <= until:
            rows.append((slot, total))
            if self.counts.containsKey((slot,)):
                self.counts.removeKey((slot,))
            coming = self._count(slot + self.steps)
            total += coming - own[0]
            own = [*own[1:], coming]
            slot += 1
            if len(rows) == AT_ONCE:
                yield self._frame(rows)
                rows = []
        if rows:
            yield self._frame(rows)
        if slot > begun:
            self.next.update((slot,))
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry[0] if isinstance(expiry, tuple) else expiry)
        self.handle.registerTimer((slot + self.steps) * self.slide_s * 1000)

    def _frame(self, rows: list[tuple[int, int]]) -> pd.DataFrame:
        start = pd.to_datetime([s * self.slide_s for s, _ in rows], unit="s")
        return pd.DataFrame({"window_start": start, "window_end": start + pd.Timedelta(seconds=self.steps * self.slide_s), "n": [n for _, n in rows]})

    def close(self) -> None:
        pass


def stream_increase(events: DataFrame, label: str, pattern: str, width_s: int = 300, slide_s: int = 60, watermark: str = "10 minutes", ts="ts") -> DataFrame:
    """``rates.matching_increase`` on a stream: each window once, in append mode, when the watermark has reached its end; 0 if nothing matched.

    The series begins with the first event. Only one row a step reaches the series' state. Run it with ``run_increase``, which sets the state store it needs.
    """
    if width_s % slide_s:
        raise ValueError("the width must be a multiple of the slide")
    hits = F.sum(F.coalesce(F.col(label).rlike(pattern), F.lit(False)).cast("int")).alias("hit")
    steps = events.withWatermark(ts, watermark).groupBy(F.window(ts, f"{slide_s} seconds")).agg(hits)
    slots = steps.select(F.window_time("window").alias("at"), F.floor(F.unix_seconds("window.start") / slide_s).cast("long").alias("slot"), "hit", F.lit(0).alias("series"))
    return slots.groupBy("series").transformWithStateInPandas(
        statefulProcessor=IncreaseProcessor(width_s // slide_s, slide_s), outputStructType=WINDOWS, outputMode="Append", timeMode="EventTime")


def run_increase(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``run_to_table`` with the state store that timers need; the session's own setting is put back."""
    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        return run_to_table(stream, path, checkpoint)
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)
