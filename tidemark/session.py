"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job relies on (UTC, adaptive execution)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "tidemark", **extra: str) -> SparkSession:
    """A single-node session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local master may go without one, as then
    all tasks see this machine's temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows over all cores, for work that is heavy per row on inputs of few splits. With
    ``rows`` a task gets about so many at most, so that what one task sorts or holds does not
    grow with the input; they are counted first, which a file's footer answers."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        tasks = max(tasks, -(-df.count() // rows))
    return df.repartition(tasks)


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder so later branches read equal rows."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
