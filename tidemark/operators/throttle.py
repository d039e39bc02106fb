"""At most one row per key and interval, measured from the last emitted row.

Which row is emitted depends on the one before it, so a key is a chain. The chain is
cut by day: every (key, day) is solved on its own as a small table "allowed from ->
last emission", the tables are walked per key, and each day then emits its rows from
the threshold it inherited. Times are reduced to distinct milliseconds first, which
bounds a (key, day) however many rows a key has.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _chain_ends(times: np.ndarray, interval: int) -> np.ndarray:
    """Last emission of the chain starting at each time, found from the back."""
    following = np.searchsorted(times, times + interval)
    ends = np.arange(len(times))
    # A step never skips back, so repeating "take my successor's end" converges in
    # log2(chain length) rounds.
    hop = np.where(following < len(times), following, ends)
    while True:
        again = hop[hop]
        if np.array_equal(again, hop):
            return times[hop]
        hop = again


def _emitted(times: np.ndarray, allowed_from: int, interval: int) -> np.ndarray:
    out = []
    at = int(np.searchsorted(times, allowed_from))
    while at < len(times):
        out.append(int(times[at]))
        at = int(np.searchsorted(times, times[at] + interval))
    return np.array(out, dtype=np.int64)


def throttle_first(
    df: DataFrame, key: str, time: Column, interval_seconds: int = 3600, chunk_seconds: int = 86400
) -> DataFrame:
    """(key, emitted_ms): the rows a rate limiter of one per interval lets through."""
    interval, width = interval_seconds * 1000, chunk_seconds * 1000
    if width < interval:
        raise ValueError("a chunk must cover at least one interval")
    times = (
        df.select(F.col(key).cast("string").alias("key"), F.unix_millis(time).alias("ms"))
        .where("key IS NOT NULL AND ms IS NOT NULL")
        .distinct()
        .withColumn("chunk", F.floor(F.col("ms") / width).cast("long"))
    )

    def solve(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ms = np.sort(pdf["ms"].to_numpy())
        ends = _chain_ends(ms, interval)
        early = int(np.searchsorted(ms, ids[1] * width + interval)) + 1
        entry, end = ms[:early], ends[:early]
        keep = np.append(end[1:] != end[:-1], True)
        return pd.DataFrame({"key": ids[0], "chunk": ids[1], "upto": entry[keep], "last": end[keep]})

    def walk(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "upto"])
        chunks, allowed, threshold = [], [], -(1 << 62)
        for chunk, part in pdf.groupby("chunk", sort=True):
            chunks.append(chunk)
            allowed.append(threshold)
            at = int(np.searchsorted(part["upto"].to_numpy(), threshold))
            if at < len(part):
                threshold = int(part["last"].iloc[at]) + interval
        return pd.DataFrame({"key": ids[0], "chunk": chunks, "allowed_from": allowed})

    def emit(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ms = np.sort(pdf["ms"].to_numpy())
        return pd.DataFrame({"key": ids[0], "emitted_ms": _emitted(ms, int(pdf["allowed_from"].iloc[0]), interval)})

    tables = times.groupBy("key", "chunk").applyInPandas(solve, "key string, chunk long, upto long, last long")
    allowed = tables.groupBy("key").applyInPandas(walk, "key string, chunk long, allowed_from long")
    return (
        times.join(allowed, ["key", "chunk"])
        .groupBy("key", "chunk")
        .applyInPandas(emit, "key string, emitted_ms long")
        .select(F.col("key").alias(key), "emitted_ms")
    )
