"""Backfill of external bundles, and the health report. Nothing here reads the clock: the
caller passes ``as_of``."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.text import storage_path
from tidemark.operators import consumers, files
from tidemark.plans.lake import RawEventTable, path_exists
from tidemark.sources.tables import read_bundles

REGISTERED = "path string, prefix string, batch string"


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp")


# ---- backfill ---------------------------------------------------------------


def registered(table: RawEventTable) -> DataFrame:
    """External files with the batch that holds them."""
    path = f"{table.root}/backfilled"
    if not path_exists(table.spark, path):
        return table.spark.createDataFrame([], REGISTERED)
    return table.spark.read.schema(REGISTERED).parquet(path)


def backfill(
    table: RawEventTable, listed: DataFrame, as_of: datetime, cap: int = fv.FILES_PER_SNAPSHOT, **options: str
) -> dict[str, int]:
    """Bring external files into the layout; a rerun registers nothing.

    ``listed`` has ``path``. Files of one prefix make batches of at most ``cap`` files, and
    each batch a snapshot. New files are registered first; then all batches that are not
    committed yet are written by one job, those of a run that stopped half way included.
    Returns registered and skipped counts.
    """
    known = registered(table)
    parquet = listed.where(F.col("path").endswith(".parquet")).select("path").distinct()
    marked = parquet.join(known.select("path").distinct().withColumn("_known", F.lit(1)), "path", "left")
    total, skipped = marked.agg(F.count(F.lit(1)), F.count("_known")).first()
    if total > skipped:
        plan = files.registration_batches(marked.where("_known IS NULL").select("path"), cap)
        run = uuid.uuid4().hex[:8]
        name = F.concat(F.lit(f"backfill-{run}-"), F.substring(F.md5("prefix"), 1, 12), F.format_string("-%06d", F.col("batch")))
        plan.select("path", "prefix", name.alias("batch")).write.mode("append").parquet(f"{table.root}/backfilled")
        known = registered(table)
    open_batches = known.join(table.commits().select("batch"), "batch", "left_anti")
    # One name for each batch of files, not for each file.
    names = [r.batch for r in open_batches.select("prefix", "batch").distinct().orderBy("prefix", "batch").collect()]
    if names:
        _write_batches(table, open_batches, names, as_of, options)
    return {"registered": total - skipped, "skipped": skipped}


def _write_batches(table: RawEventTable, placed: DataFrame, names: list[str], as_of: datetime, options: dict) -> None:
    """One job for the files of all batches. The driver holds their paths, as any reader does."""
    paths = [r[0] for r in placed.select("path").toLocalIterator()]
    # The reader reports a file with its scheme; match on the bare path.
    bare = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/*", "/")
    rows = (
        read_bundles(table.spark, paths)
        .withColumn("_path", bare(storage_path(F.col("path"))))
        .join(placed.select(bare(F.col("path")).alias("_path"), "batch"), "_path")
        .drop("_path", "path")
        .withColumn("ingest_time", _ts(as_of))
    )
    table.write_batches(rows, names, layout="range", **options)


def table_listing(table: RawEventTable) -> DataFrame:
    """Data files of the table on storage: path, size, modification time."""
    listed = files.list_objects(table.spark, table.data)
    return listed.where(F.col("key").endswith(".parquet"))


# ---- health -----------------------------------------------------------------


def health_report(
    snapshots: DataFrame,
    progress: DataFrame,
    data_files: DataFrame,
    as_of: Column,
    retention: int = fv.RETENTION_SECONDS,
    staleness: int = fv.STALENESS_SECONDS,
    age_alert: int = fv.SNAPSHOT_AGE_ALERT_SECONDS,
    backlog_alert: int = fv.BACKLOG_FILES_THRESHOLD,
) -> DataFrame:
    """(check, key, value, breached): consumers, floor, retention headroom, backlog."""
    cutoff = consumers.expire_cutoff(snapshots, progress, as_of, retention, staleness)
    stale = consumers.stale_consumers(progress, as_of, staleness)
    lost = consumers.unconsumed_expiring(snapshots, stale, cutoff.select("cutoff").scalar())

    def line(rows: DataFrame, check: str, key: Column, value: Column, breached: Column) -> DataFrame:
        return rows.select(
            F.lit(check).alias("check"), key.alias("key"), value.cast("double").alias("value"), breached.alias("breached")
        )

    none = F.lit("")
    n_stale = stale.agg(F.count("*").alias("n"))
    age = consumers.oldest_snapshot_age(snapshots, as_of)
    backlog = files.file_backlog(data_files)
    parts = [
        line(n_stale, "stale_consumers", none, F.col("n"), F.col("n") > 0),
        line(cutoff, "floor_binding", none, F.col("floor_binding").cast("int"), F.col("floor_binding")),
        line(age, "oldest_snapshot_age", none, F.col("age_seconds"), F.col("age_seconds") > age_alert),
        line(backlog, "data_files", F.col("table_name"), F.col("files"), F.col("files") > backlog_alert),
        line(backlog, "average_file_bytes", F.col("table_name"), F.floor("average_bytes"), F.lit(False)),
        line(lost, "unconsumed_loss", F.col("consumer"), F.col("lost_snapshots"), F.col("lost_snapshots") > 0),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
