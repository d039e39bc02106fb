"""Consumer cursors, the expiry floor and what expiry would lose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators.ordered import running_stats

CHUNK_SNAPSHOTS = 65_536


def _ago(as_of: Column, seconds: int) -> Column:
    return as_of - F.make_dt_interval(secs=F.lit(seconds))


def _epoch(c: Column) -> Column:
    return F.unix_micros(c) / F.lit(1_000_000.0)


def latest_progress(log: DataFrame) -> DataFrame:
    """One cursor per consumer: the last report wins (append-only upsert)."""
    best = F.max(F.struct("updated_at", "snapshot_id")).alias("_best")
    return log.groupBy("consumer").agg(best).select("consumer", "_best.snapshot_id", "_best.updated_at")


def consumer_floor(progress: DataFrame, as_of: Column, staleness: int = fv.STALENESS_SECONDS) -> DataFrame:
    """One row: lowest cursor of live consumers, NULL when none is live."""
    live = progress.where(F.col("updated_at") > _ago(as_of, staleness))
    return live.agg(F.min("snapshot_id").alias("floor"))


def stale_consumers(progress: DataFrame, as_of: Column, staleness: int = fv.STALENESS_SECONDS) -> DataFrame:
    return progress.where(F.col("updated_at") <= _ago(as_of, staleness)).select(
        "consumer", "snapshot_id", (_epoch(as_of) - _epoch(F.col("updated_at"))).alias("age_seconds")
    )


def expire_cutoff(
    snapshots: DataFrame,
    progress: DataFrame,
    as_of: Column,
    keep: int = fv.RETENTION_SECONDS,
    staleness: int = fv.STALENESS_SECONDS,
) -> DataFrame:
    """One row: ``cutoff, floor, floor_binding``. The horizon is pulled back to the
    first snapshot after the floor when that one is older."""
    floor = consumer_floor(progress, as_of, staleness)
    bound = snapshots.where(F.col("snapshot_id") > floor.scalar()).agg(
        F.min("snapshot_time").alias("bound")
    )
    horizon = _ago(as_of, keep)
    return bound.select(
        F.when(F.col("bound") < horizon, F.col("bound")).otherwise(horizon).alias("cutoff"),
        floor.scalar().alias("floor"),
        F.coalesce(F.col("bound") < horizon, F.lit(False)).alias("floor_binding"),
    )


def unconsumed_expiring(snapshots: DataFrame, stale: DataFrame, cutoff: Column) -> DataFrame:
    """Per stale consumer, the expiring snapshots beyond its cursor.

    Cursors and snapshot ids are merged into one order and counted with a distributed
    running sum, so no snapshot is paired with every consumer.
    """
    marks = snapshots.where(F.col("snapshot_time") < cutoff).select(
        F.col("snapshot_id").alias("at"),
        F.lit(0).alias("is_cursor"),
        F.lit(None).cast("string").alias("consumer"),
        F.lit(1).cast("long").alias("one"),
    )
    cursors = stale.select(
        F.col("snapshot_id").alias("at"), F.lit(1).alias("is_cursor"), "consumer", F.lit(0).cast("long").alias("one")
    )
    total = marks.agg(F.count("*"))
    # Snapshot ids are unique, so a stretch of them bounds a chunk.
    counted = running_stats(
        marks.unionByName(cursors),
        [],
        ["at", "is_cursor", "consumer"],
        running={"seen": "one"},
        chunk=F.floor(F.col("at") / CHUNK_SNAPSHOTS),
    )
    return counted.where("is_cursor = 1").select(
        "consumer",
        F.col("at").alias("snapshot_id"),
        (total.scalar() - F.col("seen")).cast("long").alias("lost_snapshots"),
    )


def expire_snapshots(snapshots: DataFrame, cutoff: Column) -> DataFrame:
    """The retained ledger: snapshots at or after the cutoff; the newest always stays."""
    newest = snapshots.agg(F.max("snapshot_id"))
    return snapshots.where((F.col("snapshot_time") >= cutoff) | (F.col("snapshot_id") == newest.scalar()))


def oldest_snapshot_age(snapshots: DataFrame, as_of: Column) -> DataFrame:
    oldest = F.min("snapshot_time")
    return snapshots.agg((_epoch(as_of) - _epoch(oldest)).alias("age_seconds"))
