"""Readers of external bundles and wire messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas

# What a micro-batch takes at most: some million messages, which compress well.
BYTES_OF_A_TRIGGER = 128 << 20


def read_bundles(spark: SparkSession, files: list[str]) -> DataFrame:
    """External Parquet files under the table schema: a column a file lacks reads as
    NULL. ``path`` says where each row came from."""
    return (
        spark.read.schema(schemas.RAW_EVENTS)
        .parquet(*files)
        .select("*", F.col("_metadata.file_path").alias("path"))
    )


def read_event_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    schema=schemas.WIRE_MESSAGES,
    max_bytes_per_trigger: int = BYTES_OF_A_TRIGGER,
) -> DataFrame:
    """Wire messages as a stream of files, bounded per trigger by their number where one is
    given, else by their bytes.

    One task reads a whole row group, which may be a whole file; what follows is heavy per
    row, so rows are spread over all cores first, by the place they lie at: rows that are
    dealt out in turn would be sorted before."""
    bound = ("maxBytesPerTrigger", max_bytes_per_trigger) if max_files_per_trigger is None else ("maxFilesPerTrigger", max_files_per_trigger)
    rows = spark.readStream.schema(schema).option(*bound).parquet(path)
    placed = rows.select("*", F.col("_metadata.row_index").alias("_place"))
    return placed.repartition(spark.sparkContext.defaultParallelism, "_place").drop("_place")


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 5_000_000
) -> DataFrame:
    """The same messages from a Kafka topic (needs the connector on the cluster)."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )
    headers = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"], F.decode(h["value"], "UTF-8")))
    )
    return records.select(
        F.decode("value", "UTF-8").alias("value"), headers.alias("headers"), F.col("timestamp").alias("ingest_time")
    )


def sample_events(raw_events: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows with an inline JSON payload, in time and id order."""
    inline = raw_events.where(
        F.col("data").isNotNull() & (F.col("data_content_type") == "application/json")
    )
    return inline.orderBy("time", "id").limit(n)
