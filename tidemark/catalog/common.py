"""Shared by the query catalog: table loading and the adapters that present the given
tables as messages, raw events, snapshots and files.

An adapter is one SELECT that both Spark and the checking engine accept. ``{events}``
and the like name a table; ``ISO(x)`` is a timestamp as RFC 3339 text with micros.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators.ordered import running_stats
from tidemark.session import configure, spread

Query = Callable[[SparkSession, str], DataFrame]

CHAIN = 137
CONTRACT = "0xba5738a18d83d41847dffbdc6101d37c69c9b0cf"
SOURCE = "0xc0dec0dec0dec0dec0dec0dec0dec0dec0dec0de"
DID = f"did:erc721:{CHAIN}:{CONTRACT}:"
AS_OF = "2024-02-01 00:00:00"

# Given rows become several rows or a long text each where ``spread`` is used.
ROWS_OF_A_TASK = 100_000


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def adapt(
    spark: SparkSession, directory: str, text: str, zoned: tuple[str, ...] = (), heavy: bool = False
) -> DataFrame:
    """Run an adapter in Spark; ``zoned`` columns become UTC timestamps. ``heavy`` says
    that costly expressions per row follow."""
    names = sorted(set(re.findall(r"\{(\w+)\}", text)))
    tables = {n: load(spark, directory, n) for n in names}
    if heavy:
        tables = {n: spread(t, ROWS_OF_A_TASK) for n, t in tables.items()}
    iso = "date_format(\\1, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    for name, table in tables.items():
        table.createOrReplaceTempView(f"adapter_{name}")
        text = text.replace("{" + name + "}", f"adapter_{name}")
    out = spark.sql(re.sub(r"ISO\(([^()]*)\)", iso, text))
    return out.withColumns({c: F.col(c).cast("timestamp") for c in zoned})


def oracle(text: str) -> str:
    """The same adapter for the checking engine."""
    text = re.sub(r"ISO\(([^()]*)\)", r"strftime(\1, '%Y-%m-%dT%H:%M:%S.%fZ')", text)
    return re.sub(r"\{(\w+)\}", r"\1", text)


def millis(column: str, name: str | None = None):
    return F.unix_millis(column).alias(name or f"{column}_ms")


RAW = f"""
SELECT concat('{DID}', CAST(event_id % 150 AS STRING)) AS subject,
       date_trunc('millisecond', ts) AS time,
       CASE event_type WHEN 'click' THEN '{fv.TYPE_STATUS}' WHEN 'view' THEN '{fv.TYPE_EVENTS}'
            WHEN 'error' THEN '{fv.TYPE_FINGERPRINT}' WHEN 'signup' THEN '{fv.TYPE_ATTESTATION}'
            ELSE '{fv.TYPE_TOMBSTONE}' END AS type,
       CAST(event_id AS STRING) AS id,
       '{SOURCE}' AS source,
       concat('{DID}', CAST(event_id % 150 + 1000 AS STRING)) AS producer,
       'application/json' AS data_content_type,
       'default/v1.0' AS data_version,
       props AS data,
       CASE WHEN event_type = 'purchase' AND event_id >= 600
            THEN CAST(event_id - 150 * (1 + event_id % 3) AS STRING) END AS voids_id,
       CAST(floor(event_id / 100) AS BIGINT) AS snapshot_id,
       ts AS ingest_time
FROM {{events}}
"""

# Every seventh event arrives a second time in the next snapshot.
RAW_DUP = f"""
SELECT * FROM ({RAW}) first_arrival
UNION ALL
SELECT subject, time, type, id, source, producer, data_content_type, data_version, data, voids_id,
       snapshot_id + 1 AS snapshot_id, ingest_time
FROM ({RAW}) second_arrival WHERE CAST(id AS BIGINT) % 7 = 0
"""

TIMES = ("time", "ingest_time")


def raw_events(spark: SparkSession, directory: str, heavy: bool = False) -> DataFrame:
    return adapt(spark, directory, RAW, TIMES, heavy)


def raw_events_dup(spark: SparkSession, directory: str) -> DataFrame:
    return adapt(spark, directory, RAW_DUP, TIMES)


# Key text of an event in the checking engine.
KEY_SQL = "concat_ws('|', subject, strftime(time, '%Y-%m-%dT%H:%M:%S.%gZ'), type, source, id)"

DATA_FILES = """
SELECT concat('lake/', l_returnflag, '/', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING),
              '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '.parquet') AS path,
       max(l_linestatus) AS table_name,
       max(l_returnflag) AS flag,
       max(CAST(l_shipdate AS DATE)) AS day,
       CAST(max(floor(l_extendedprice * 100)) AS BIGINT) AS bytes,
       CAST(max(l_quantity) AS BIGINT) AS "rows",
       max(l_shipdate) AS modified,
       max(l_orderkey) AS added_snapshot,
       max(CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey + l_suppkey END) AS removed_snapshot,
       max(l_linenumber) AS line
FROM {lineitem} GROUP BY 1
"""


def data_files(spark: SparkSession, directory: str) -> DataFrame:
    return adapt(spark, directory, DATA_FILES.replace('"rows"', "rows"), ("modified",))


SNAPSHOTS_SQL = (
    "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS snapshot_id, o_orderdate AS snapshot_time FROM orders"
)


def snapshots(spark: SparkSession, directory: str) -> DataFrame:
    """Orders as snapshots, numbered by date without a single-task window."""
    orders = load(spark, directory, "orders").select("o_orderdate", "o_orderkey")
    numbered = running_stats(
        orders,
        [],
        ["o_orderdate", "o_orderkey"],
        number="snapshot_id",
        chunk=F.date_trunc("month", F.col("o_orderdate")),
    )
    return numbered.select("snapshot_id", F.col("o_orderdate").cast("timestamp").alias("snapshot_time"))


PROGRESS_LOG = f"""
SELECT concat('consumer-', CAST(s_suppkey % 20 AS STRING)) AS consumer,
       s_suppkey * 100 AS snapshot_id,
       TIMESTAMP '{AS_OF}' - s_nationkey * INTERVAL '10' MINUTE - s_suppkey * INTERVAL '1' SECOND AS updated_at
FROM {{supplier}}
"""

LATEST_SQL = (
    f"SELECT consumer, arg_max(snapshot_id, updated_at) AS snapshot_id, max(updated_at) AS updated_at "
    f"FROM ({oracle(PROGRESS_LOG)}) l GROUP BY consumer"
)


def progress_log(spark: SparkSession, directory: str) -> DataFrame:
    return adapt(spark, directory, PROGRESS_LOG, ("updated_at",))
