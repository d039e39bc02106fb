"""Micro-batches with names that survive restarts."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of this checkpoint. It survives restarts and is new
    for a new checkpoint, so it names batches without ever reusing a name."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def start_named(rows: DataFrame, write, checkpoint: str, query: str, trigger: dict | None) -> StreamingQuery:
    """Run ``write(batch, name)`` per micro-batch; a replayed batch has the same name."""
    known = []

    def named(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(checkpoint_id(batch.sparkSession, checkpoint))
        write(batch, f"{query}-{known[0]}-{batch_id}")

    return (
        rows.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .queryName(query)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore"
STATE_ON_DISK = {
    f"{_STORE}.providerClass": ROCKSDB,
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    # One bound for all stores of an executor, in MB; without it each has buffers of its own.
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "500",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state on local disk with changes in the checkpoint,
    instead of in the heap. A query takes its settings along when it starts; those of the
    session are put back, and a checkpoint goes on with the store it began with."""
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    try:
        for key, value in STATE_ON_DISK.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
