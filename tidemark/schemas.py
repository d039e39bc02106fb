"""Explicit schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_EVENT_COLUMNS = [
    "subject",
    "time",
    "type",
    "id",
    "source",
    "producer",
    "data_content_type",
    "data_version",
    "extras",
    "data",
    "data_base64",
    "data_index_key",
    "voids_id",
]

RAW_EVENTS = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("producer", T.StringType()),
        T.StructField("data_content_type", T.StringType()),
        T.StructField("data_version", T.StringType()),
        T.StructField("extras", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("data_base64", T.BinaryType()),
        T.StructField("data_index_key", T.StringType()),
        T.StructField("voids_id", T.StringType()),
    ]
)

PARTITION_COLUMNS = ["type", "year", "month", "day"]

TABLE_ROWS = T.StructType(
    RAW_EVENTS.fields
    + [
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("batch", T.StringType()),
    ]
)

WIRE_MESSAGES = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ingest_time", T.TimestampType()),
    ]
)

CONSUMER_PROGRESS = "consumer string, snapshot_id bigint, updated_at timestamp"

SIGNAL = "struct<name:string,timestamp:timestamp,value:double,location:struct<lat:double,lon:double,hdop:double>>"
