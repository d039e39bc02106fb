"""Silences of series on a stream: timers that fire although nothing arrives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Silences(StatefulProcessor):
    """State of a series: its newest time, and whether the silence after it was reported.

    A timer stands at the newest time plus the longest gap. If a later row comes first, the
    timer moves on; gaps between rows that come together are reported from the rows."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_ms long, reported boolean")

    def _rows(self, key, starts: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"series": [key[0]] * len(starts), "since_ms": np.array(starts, np.int64)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, reported = self.last.get() if self.last.exists() else (None, False)
        times = np.zeros(0, np.int64)
        for pdf in rows:
            times = np.union1d(times, pdf["ms"].to_numpy())
        if last is not None:
            times = np.concatenate([[last], times[times > last]])
        far = np.flatnonzero(np.diff(times) > self.gap_ms)
        starts = [int(times[i]) for i in far if not (reported and times[i] == last)]
        newest = int(times[-1])
        if newest != last:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(newest + self.gap_ms)
            self.last.update((newest, False))
        if starts:
            yield self._rows(key, starts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, reported = self.last.get()
        if not reported:
            self.last.update((last, True))
            yield self._rows(key, [last])

    def close(self) -> None:
        pass


def silence_stream(samples: DataFrame, series: str, ts: str, max_gap_seconds: int = 900, delay: str = "1 minute") -> DataFrame:
    """(series, since_ms): every silence longer than the gap, once, with the time of the last
    sample before it. Event time passes with the samples of all series, so one that stopped
    is reported while others go on; rows later than ``delay`` are left out. Start the query
    in a session with ``throttle.use_rocksdb``."""
    known = samples.where(F.col(series).isNotNull() & F.col(ts).isNotNull())
    named = known.select(F.col(series).cast("string").alias("series"), F.col(ts).alias("at"), F.unix_millis(ts).alias("ms"))
    return named.withWatermark("at", delay).groupBy("series").transformWithStateInPandas(
        Silences(max_gap_seconds * 1000), "series string, since_ms long", "append", "EventTime"
    )


def since(column: str = "since_ms") -> Column:
    return F.timestamp_millis(column)
