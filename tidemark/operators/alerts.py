"""Health rules over metric samples (series, ts, value) as reductions and chunked
order operators; no rule gathers a whole series in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators.ordered import running_stats


def backlog_growing(
    samples: DataFrame,
    table: str,
    ts: str,
    files: str,
    hours: int = 2,
    threshold: int = fv.BACKLOG_FILES_THRESHOLD,
) -> DataFrame:
    """Per sample: its count, the growth over the rolling ``hours`` before it (against the
    oldest sample in them), and whether the count is above the floor and growing.

    A sample asks for the first sample at or after the start of its ``hours``. Questions are
    put among the samples of the chunk in which they fall, last one first, so the nearest
    later sample is the last one seen; behind the end of a chunk that is the first sample of
    the next one. A frame that moves over samples would be read anew for every row."""
    span = hours * 3_600_000_000
    own = samples.select(F.col(table), F.col(ts), F.col(files), F.unix_micros(ts).alias("_us"))
    held = F.struct(F.col(files).alias("v"))
    chunk = lambda at: F.floor(at / span).alias("_chunk")
    seen = own.select(table, chunk(F.col("_us")), F.col("_us").alias("_at"), held.alias("_held"))
    ahead = (
        seen.groupBy(table, "_chunk")
        .agg(F.min(F.struct("_at", "_held")).alias("_first"))
        .select(table, (F.col("_chunk") - 1).alias("_chunk"), "_first.*")
    )
    start = F.col("_us") - span
    asked = own.select(table, chunk(start), start.alias("_at"), F.lit(None).cast(seen.schema["_held"].dataType).alias("_held"), ts, files)
    every = asked.unionByName(seen.unionByName(ahead).withColumn("_sample", F.lit(True)), allowMissingColumns=True)
    # Of samples at one instant the least counts.
    order = [F.desc("_at"), F.desc_nulls_last("_sample"), F.desc("_held")]
    later = Window.partitionBy(table, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    oldest = F.last("_held", ignorenulls=True).over(later)["v"]
    grown = every.withColumn("growth", F.col(files) - oldest).where("_sample IS NULL")
    breached = (F.col(files) > threshold) & (F.col("growth") > 0)
    return grown.select(table, ts, F.col(files).alias("current_files"), "growth", breached.alias("breached"))


def counter_increase(
    samples: DataFrame, series: str, ts: str, value: str, window: str = "15 minutes"
) -> DataFrame:
    """Counter growth per series and window. A drop is a reset: the counter restarted
    from zero, so the new value itself is the growth."""
    placed = samples.withColumn("window_start", F.window(ts, window)["start"])
    stepped = running_stats(
        placed,
        [series, "window_start"],
        [ts],
        previous={"_before": value},
        chunk=F.date_trunc("minute", F.col(ts)),
    )
    change = F.when(F.col("_before").isNull(), F.lit(0)).when(
        F.col(value) < F.col("_before"), F.col(value)
    )
    return stepped.groupBy(series, "window_start").agg(
        F.sum(change.otherwise(F.col(value) - F.col("_before"))).alias("increase")
    )


def heartbeat_gaps(samples: DataFrame, series: str, ts: str, as_of: Column, max_gap_seconds: int = 900) -> DataFrame:
    """Silences longer than ``max_gap_seconds``, including the one up to ``as_of``.

    Two samples of one bucket are never further apart than the bucket, so samples are
    reduced to first and last per bucket and only buckets are ordered.
    """
    bucket = F.floor(F.unix_micros(ts) / (max_gap_seconds * 1_000_000))
    reduced = samples.groupBy(series, bucket.alias("_bucket")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    order = Window.partitionBy(series).orderBy("_bucket")
    inner = reduced.select(series, F.lag("_last").over(order).alias("gap_start"), F.col("_first").alias("gap_end"))
    final = reduced.groupBy(series).agg(F.max("_last").alias("gap_start")).withColumn("gap_end", as_of)
    length = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return inner.unionByName(final).where(length > max_gap_seconds * 1_000_000)


def cycle_stalled(samples: DataFrame, series: str, ts: str, as_of: Column, seconds: int = fv.CYCLE_STALLED_SECONDS) -> DataFrame:
    """Series whose newest success is older than ``seconds``."""
    age = (F.unix_micros(as_of) - F.unix_micros(F.max(ts))) / F.lit(1_000_000.0)
    return samples.groupBy(series).agg(age.alias("age_seconds")).where(F.col("age_seconds") > seconds)


def sustained(
    samples: DataFrame, series: str, ts: str, condition: Column, seconds: int, chunk: str = "hour"
) -> DataFrame:
    """Stretches during which ``condition`` held for at least ``seconds``.

    Runs are found inside each chunk. A run that touches neither end of its chunk is
    complete; only the first and last run of each chunk are ordered across chunks.
    """
    within = Window.partitionBy(series, "_chunk").orderBy(ts)
    placed = samples.select(
        series, ts, F.coalesce(condition, F.lit(False)).alias("_on"), F.date_trunc(chunk, F.col(ts)).alias("_chunk")
    )
    flips = placed.withColumn("_flip", F.coalesce((F.lag("_on").over(within) != F.col("_on")).cast("int"), F.lit(1)))
    runs = (
        flips.withColumn("_run", F.sum("_flip").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(series, "_chunk", "_run")
        .agg(F.first("_on").alias("_on"), F.min(ts).alias("started"), F.max(ts).alias("ended"))
        .withColumn("_is_first", F.col("_run") == 1)
        .withColumn("_is_last", F.col("_run") == F.max("_run").over(Window.partitionBy(series, "_chunk")))
    )
    inner = runs.where("NOT _is_first AND NOT _is_last AND _on").select(series, "started", "ended")
    across = Window.partitionBy(series).orderBy("_chunk", "_run")
    follows = F.lag("_is_last").over(across) & F.col("_is_first") & (F.lag("_on").over(across) == F.col("_on"))
    edges = (
        runs.where("_is_first OR _is_last")
        .withColumn("_new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
        .withColumn("_island", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(series, "_island")
        .agg(F.first("_on").alias("_on"), F.min("started").alias("started"), F.max("ended").alias("ended"))
        .where("_on")
        .select(series, "started", "ended")
    )
    length = F.unix_micros("ended") - F.unix_micros("started")
    return inner.unionByName(edges).where(length >= seconds * 1_000_000)


def failing_unless_committing(failures: DataFrame, commits: DataFrame, pod: str, amount: str) -> DataFrame:
    """Pods with failures and not one commit."""
    failing = failures.groupBy(pod).agg(F.sum(amount).alias("failures")).where("failures > 0")
    committing = commits.groupBy(pod).agg(F.sum(amount).alias("_n")).where("_n > 0").select(pod)
    return failing.join(committing, pod, "left_anti")
