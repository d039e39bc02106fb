"""Consumers of the table: its commits as a stream, their rows, and a cursor for each one.

A micro-batch is a set of commits, taken once each in the order in which they appear. What
the consumer does with their rows is named by the checkpoint and the batch number, so a
repeated micro-batch can replace what it wrote. When Spark has committed the micro-batch, a
listener writes the cursor, so a cursor never runs ahead of what was done.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.plans.lake import RawEventTable
from tidemark.streaming.batches import start_named

CURSOR = "cursor"


class Cursors(StreamingQueryListener):
    """Writes the cursor of one consumer after each of its micro-batches, and again while
    it is idle: a consumer without new commits is alive and must not go stale."""

    def __init__(self, table: RawEventTable, consumer: str):
        self.table, self.consumer = table, consumer
        self.query, self.last = None, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.consumer:
            self.query = event.id

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.consumer:
            return
        seen = event.progress.observedMetrics.get(CURSOR)
        if seen is not None and seen["last"] is not None:
            self.last = max(self.last or 0, seen["last"])
        self._write()

    def onQueryIdle(self, event) -> None:
        if event.id == self.query:
            self._write()

    def onQueryTerminated(self, event) -> None:
        if event.id == self.query:
            self.table.spark.streams.removeListener(self)

    def _write(self) -> None:
        if self.last is not None:
            self.table.record_progress(self.consumer, self.last, datetime.now(timezone.utc))


def consume(
    table: RawEventTable,
    consumer: str,
    handle: Callable[[DataFrame, str], None],
    checkpoint: str,
    max_commits: int = 100,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``handle(rows, batch name)`` over every commit of the table, once.

    ``rows`` are those of at most ``max_commits`` commits with their ``snapshot_id``; only
    the folders that these commits wrote are listed. Writers may overtake each other: a
    commit has its number from the moment it appears, so none is passed over. The driver
    holds the commits of one micro-batch, never their rows.
    """
    table.spark.streams.addListener(Cursors(table, consumer))
    commits = table.read_stream(max_commits).observe(CURSOR, F.max("snapshot_id").alias("last"))

    def write(batch: DataFrame, name: str) -> None:
        found = batch.collect()
        if found:
            handle(table.rows_of(found), name)

    return start_named(commits, write, checkpoint, consumer, trigger)
