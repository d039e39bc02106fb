"""The limiter as a stateful operator: one row per key and interval in processing order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "last"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pa.Table.from_batches([batch]).group_by(["key", "ms"], use_threads=False).aggregate([]).to_batches()


class Limiter(StatefulProcessor):
    """State is the last emitted time of a key. Spark drops it an interval later, which
    bounds the state to the keys that were let through within the interval."""

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(STATE, "last_ms long", ttlDurationMs=self.interval_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = np.zeros(0, np.int64)
        for pdf in rows:
            held = np.union1d(held, pdf["ms"].to_numpy())
        last = self.last.get()[0] if self.last.exists() else None
        out, at = [], 0 if last is None else int(np.searchsorted(held, last + self.interval_ms))
        while at < len(held):
            out.append(int(held[at]))
            at = int(np.searchsorted(held, held[at] + self.interval_ms))
        if out:
            self.last.update((out[-1],))
            yield pd.DataFrame({"key": [key[0]] * len(out), "emitted_ms": np.array(out, np.int64)})

    def close(self) -> None:
        pass


def throttle_stream(rows: DataFrame, key: str, time: Column, interval_seconds: int = 3600) -> DataFrame:
    """(key, emitted_ms). Rows without a key or a time are left out.

    A batch of rows is reduced to its distinct (key, millisecond) pairs before the exchange,
    so what a hot key sends to the task of its state is bounded by milliseconds, not rows;
    that task holds the distinct times of one key. Start the query in a session with
    ``use_rocksdb``: this kind of state needs that store.
    """
    times = rows.select(F.col(key).cast("string").alias("key"), F.unix_millis(time).alias("ms"))
    reduced = times.where("key IS NOT NULL AND ms IS NOT NULL").mapInArrow(_distinct, "key string, ms long")
    return reduced.groupBy("key").transformWithStateInPandas(
        Limiter(interval_seconds * 1000), "key string, emitted_ms long", "append", "ProcessingTime"
    )


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with changes in the checkpoint, instead of in the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def throttle_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, last_ms) as the last committed micro-batch left it, by the state reader."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return state.select("key.key", F.col("value.value.last_ms").alias("last_ms"))
