"""Externalising large payloads and putting them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import checks, identity


def mark_split(
    events: DataFrame,
    threshold: int = fv.SPLIT_THRESHOLD_BYTES,
    prefix: str = fv.BLOB_PREFIX,
) -> DataFrame:
    """Add ``blob_key`` (NULL stays inline), ``blob_payload`` and ``split_fault``."""
    big = checks.needs_split(F.col("data"), F.col("data_base64"), threshold)
    is_base64 = ~checks.is_blank(F.col("data_base64"))
    bytes_of = F.when(is_base64, F.try_to_binary("data_base64", F.lit("base64"))).otherwise(
        F.encode("data", "UTF-8")
    )
    payload = F.col("blob_payload")
    key = identity.blob_key(prefix, F.col("subject"), F.col("ingest_time"), identity.event_key(), payload)
    return (
        events.withColumn("_big", big)
        .withColumn("blob_payload", F.when(F.col("_big"), bytes_of))
        .withColumn(
            "split_fault",
            F.when(F.col("_big") & F.col("blob_payload").isNull(), F.lit("undecodable_base64")),
        )
        .withColumn("blob_key", F.when(F.col("blob_payload").isNotNull(), key))
        .drop("_big")
    )


def split_payloads(
    events: DataFrame,
    threshold: int = fv.SPLIT_THRESHOLD_BYTES,
    prefix: str = fv.BLOB_PREFIX,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored, blobs, faults). Blobs carry one row per key, copies reduced early.

    Write ``blobs`` before ``stored`` so no stored key dangles.
    """
    marked = mark_split(events, threshold, prefix)
    external = F.col("blob_key").isNotNull()
    stored = (
        marked.where("split_fault IS NULL")
        .withColumns(
            {
                "data": F.when(~external, F.col("data")),
                "data_base64": F.when(~external, F.col("data_base64")),
                "data_index_key": F.coalesce("blob_key", "data_index_key"),
            }
        )
        .drop("blob_key", "blob_payload", "split_fault")
    )
    blobs = (
        marked.where(external)
        .select(F.col("blob_key").alias("data_index_key"), F.col("blob_payload").alias("payload"))
        .dropDuplicates(["data_index_key"])
    )
    faults = marked.where("split_fault IS NOT NULL").drop("blob_key", "blob_payload")
    return stored, blobs, faults.withColumnRenamed("split_fault", "reject_reason")


def rehydrate_payloads(raw_events: DataFrame, blobs: DataFrame) -> DataFrame:
    """Every row with its ``payload`` bytes; only rows holding a key are shuffled. A blob
    may have been written by several batches: its key names its bytes, so one is taken."""
    inline = raw_events.where("data_index_key IS NULL").withColumn(
        "payload",
        F.coalesce(
            F.try_to_binary(F.decode("data_base64", "UTF-8"), F.lit("base64")), F.encode("data", "UTF-8")
        ),
    )
    external = raw_events.where("data_index_key IS NOT NULL").join(
        blobs.select("data_index_key", "payload").dropDuplicates(["data_index_key"]), "data_index_key", "left"
    )
    return inline.unionByName(external.select(*inline.columns))
