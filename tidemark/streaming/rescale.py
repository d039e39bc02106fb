"""Changing the number of routing partitions: the old stream must be drained first.

A subject goes to the partition that its hash and the partition count name. Were rows of the
new layout taken while rows of the old one still wait, the events of a subject could pass
each other. The checkpoint says what was planned, what was finished and which files were
taken, so a switch is proved safe by reading it, and refused otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import one_slash
from tidemark.operators.files import list_objects
from tidemark.plans.lake import SmallFiles, path_exists


class NotDrained(RuntimeError):
    """The old stream still has rows."""


def _last(spark: SparkSession, folder: str) -> int:
    names = [n for n in SmallFiles(spark, folder).names() if n.isdigit()]
    return max(map(int, names), default=-1)


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path`` of every file that the file source of a checkpoint has planned."""
    folder = f"{checkpoint.rstrip('/')}/sources/0"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "path string")
    lines = spark.read.text(folder).where(F.col("value").startswith("{"))
    return lines.select(one_slash(F.get_json_object("value", "$.path")).alias("path")).distinct()


def waiting_files(spark: SparkSession, checkpoint: str, source: str) -> DataFrame:
    """``path`` of the source's files that no micro-batch has planned."""
    listed = list_objects(spark, source).where(F.col("key").endswith(".parquet")).select(one_slash(F.col("path")).alias("path"))
    return listed.join(taken_files(spark, checkpoint), "path", "left_anti")


def drain_report(spark: SparkSession, checkpoint: str, source: str) -> DataFrame:
    """One row: last planned and last finished micro-batch, files that wait, and whether the
    stream is drained. Stop the query first."""
    root = checkpoint.rstrip("/")
    planned, done = _last(spark, f"{root}/offsets"), _last(spark, f"{root}/commits")
    waiting = waiting_files(spark, checkpoint, source).agg(F.count(F.lit(1)).alias("waiting_files"))
    drained = (F.col("waiting_files") == 0) & F.lit(planned == done)
    return waiting.select(F.lit(planned).alias("planned"), F.lit(done).alias("finished"), "waiting_files", drained.alias("drained"))


def state_partitions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Partitions of each stateful operator of a checkpoint. They are fixed for its life: a
    new count needs a new checkpoint."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select("operatorName", "numPartitions").distinct()


def switch(spark: SparkSession, checkpoint: str, source: str, start: Callable[[], object]):
    """Run ``start`` (the query of the new layout, with a checkpoint of its own) if the old
    one is drained, else raise."""
    row = drain_report(spark, checkpoint, source).first()
    if not row.drained:
        raise NotDrained(f"{row.waiting_files} files wait; batch {row.planned} planned, {row.finished} finished")
    return start()
