"""Duplicate handling. Reductions are aggregates, so map-side combining absorbs a
key that holds a large share of all rows; no window ever gathers one key's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.identity import KEY_FIELDS


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order``; remaining ties fall to the other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def dedup_latest(raw_events: DataFrame) -> DataFrame:
    """Read-side deduplication by event key, newest snapshot wins."""
    return keep_latest(raw_events, KEY_FIELDS, ["snapshot_id"])


def duplicate_volume(raw_events: DataFrame) -> DataFrame:
    """Rows beyond the first of each event key, by type and day."""
    per_key = raw_events.groupBy(*KEY_FIELDS).agg(F.count("*").alias("copies"))
    return per_key.groupBy("type", F.to_date("time").alias("day")).agg(
        F.count("*").alias("keys"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        F.max("copies").alias("max_copies"),
    )


def unseen_rows(new: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Insert anti-join: rows of ``new`` whose key the target lacks, one per key.

    ``new`` is reduced first, so both join sides hold each key once at most on the
    left; prune ``target`` to the dates of ``new`` before calling.
    """
    rest = [c for c in new.columns if c not in keys]
    single = new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
    return single.join(target.select(*keys), keys, "left_anti").select(*new.columns)


def void_resolution(raw_events: DataFrame) -> DataFrame:
    """Live events: those no tombstone of the same subject refers to.

    Tombstones stay visible. The voided side is reduced to unique pairs, and the
    join type lets adaptive execution split a hot pair on the event side.
    """
    voided = (
        raw_events.where((F.col("type") == fv.TYPE_TOMBSTONE) & F.col("voids_id").isNotNull())
        .select("subject", F.col("voids_id").alias("id"))
        .distinct()
    )
    tombstones = raw_events.where(F.col("type") == fv.TYPE_TOMBSTONE)
    others = raw_events.where(F.coalesce(F.col("type") != fv.TYPE_TOMBSTONE, F.lit(True)))
    return others.join(voided, ["subject", "id"], "left_anti").select(*raw_events.columns).unionByName(tombstones)


def ingest_lag(accepted: DataFrame, table: DataFrame, partition: str = "route_partition") -> DataFrame:
    """Accepted rows not yet in the table, per route partition, with the alert flag."""
    pending = accepted.join(table.select(*KEY_FIELDS), KEY_FIELDS, "left_anti")
    counted = pending.groupBy(partition).agg(F.count("*").alias("pending_rows"))
    return counted.withColumn("breached", F.col("pending_rows") > fv.PENDING_ROWS_THRESHOLD)
