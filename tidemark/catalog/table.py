"""Queries that write a real table from the given events and read it back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark import schemas
from tidemark.catalog.common import CHAIN, CONTRACT, DID, RAW, SOURCE, adapt, millis, oracle, raw_events
from tidemark.operators import decode, reports
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.files import list_objects
from tidemark.plans import maintenance
from tidemark.plans.lake import RawEventTable
from tidemark.session import scratch_path
from tidemark.sources.tables import read_event_stream
from tidemark.streaming import jobs

QUERIES: dict = {}
ORACLES: dict = {}

R = f"raw AS ({oracle(RAW)})"
AT = datetime(2024, 2, 1)

# Messages of a file at most. A micro-batch takes a number of files, so what it holds at once
# does not grow with the given tables.
ROWS_OF_A_FILE = 250_000


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def complete(rows):
    """The columns the adapter leaves out."""
    return rows.withColumns(
        {
            "extras": F.lit("{}"),
            "data_base64": F.lit(None).cast("binary"),
            "data_index_key": F.lit(None).cast("string"),
        }
    )


def new_table(spark) -> RawEventTable:
    return RawEventTable(spark, scratch_path(spark, "table"))


@query(
    "write_and_read_table",
    f"""WITH {R} SELECT id, subject, epoch_ms(time) AS time_ms, data, coalesce(voids_id, '') AS voids_id FROM raw
WHERE type = '{fv.TYPE_TOMBSTONE}' AND time >= TIMESTAMP '2024-01-03 00:00:00' AND time < TIMESTAMP '2024-01-25 12:00:00'""",
)
def write_and_read_table(spark, d):
    table = new_table(spark)
    table.write(complete(raw_events(spark, d)), "one", layout="range")
    rows = table.read(fv.TYPE_TOMBSTONE, datetime(2024, 1, 3), datetime(2024, 1, 25, 12))
    return rows.select("id", "subject", millis("time"), "data", F.coalesce("voids_id", F.lit("")).alias("voids_id"))


@query(
    "backfill_bundles",
    f"WITH {R} SELECT type, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS events, count(DISTINCT subject) AS subjects FROM raw GROUP BY ALL",
)
def backfill_bundles(spark, d):
    """Bundles as an older system left them: by arrival day, without the void column."""
    rows = complete(raw_events(spark, d)).drop("voids_id", "snapshot_id")
    bundles = scratch_path(spark, "bundles")
    named = rows.withColumn("bundle_day", F.to_date("ingest_time").cast("string")).drop("ingest_time")
    named.write.partitionBy("bundle_day").parquet(bundles)
    table = new_table(spark)
    listed = list_objects(spark, bundles).where(F.col("key").endswith(".parquet"))
    maintenance.backfill(table, listed, AT, cap=5)
    maintenance.backfill(table, listed, AT, cap=5)
    counts = reports.table_counts(table.read())
    return counts.withColumn("day", F.col("day").cast("string"))


# Every event lies below a day of January that its id names, in falling order.
_FAULTY = "SELECT *, CAST(CAST(id AS BIGINT) % 16 + 1 AS INTEGER) AS folder FROM raw"


@query(
    "layout_audit",
    f"""WITH {R}, x AS ({_FAULTY}), f AS (
SELECT type, folder, count(*) AS row_count, count(DISTINCT (subject, time)) - 1 AS unsorted_rows,
       count(*) FILTER (CAST(time AS DATE) <> make_date(2024, 1, folder)) AS misplaced_rows FROM x GROUP BY ALL)
SELECT folder, CAST(sum(row_count) AS BIGINT) AS row_count, CAST(sum(unsorted_rows) AS BIGINT) AS unsorted_rows,
       CAST(sum(misplaced_rows) AS BIGINT) AS misplaced_rows FROM f GROUP BY folder""",
)
def layout_audit(spark, d):
    """A layout with known faults: wrong days, and files against the order."""
    table = new_table(spark)
    number = F.col("id").cast("long")
    # The year and the month are no constants to the optimizer, so the sort below keeps them
    # and the writer, which wants that order, does not sort again.
    date = {"year": number % 1 + 2024, "month": number % 1 + 1, "day": number % 16 + 1}
    rows = complete(raw_events(spark, d))
    rows = rows.withColumns({name: c.cast("int") for name, c in date.items()})
    order = [*schemas.PARTITION_COLUMNS, F.desc("subject"), F.desc("time")]
    falling = rows.repartition("type", "day").sortWithinPartitions(*order)
    columns = [*schemas.RAW_EVENT_COLUMNS, "ingest_time", "year", "month", "day", F.lit("falling").alias("batch")]
    falling.select(*columns).write.partitionBy(*schemas.PARTITION_COLUMNS, "batch").parquet(table.data)
    table.commit("falling", "falling", [])
    audit = reports.layout_audit(table.stored())
    folder = F.regexp_extract("file_path", "/day=([0-9]+)/", 1).cast("int").alias("folder")
    return audit.groupBy(folder).agg(*[F.sum(c).alias(c) for c in ("row_count", "unsorted_rows", "misplaced_rows")])


@query(
    "table_files",
    f"""WITH {R} SELECT type, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
       CAST(day(time) AS INTEGER) AS day, count(*) AS events, true AS has_bytes FROM raw GROUP BY ALL""",
)
def table_files(spark, d):
    """Files of a written table by partition: the rows in them, and that all have bytes."""
    table = new_table(spark)
    table.write(complete(raw_events(spark, d)), "one", layout="range")
    rows = spark.read.schema(schemas.TABLE_ROWS).parquet(table.data)
    size = F.col("_metadata.file_size").alias("bytes")
    files = rows.groupBy(*schemas.PARTITION_COLUMNS, F.col("_metadata.file_path").alias("path"), size).agg(F.count("*").alias("rows"))
    return files.groupBy(*schemas.PARTITION_COLUMNS).agg(F.sum("rows").alias("events"), (F.min("bytes") > 0).alias("has_bytes"))


@query(
    "lanes_written",
    "SELECT 'speed' AS name_token, count(*) AS events FROM events WHERE event_type = 'click' UNION ALL SELECT 'a_b', count(*) FROM events WHERE event_type = 'click'",
)
def lanes_written(spark, d):
    """Two batches of decoded signals in lanes, one of them written twice, read back."""
    target = scratch_path(spark, "lanes")
    stamp = F.date_format("ingest_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def signal(name):
        return F.concat(F.lit(f'{{"name":"{name}","timestamp":"'), stamp, F.lit('","value":1}'))

    data = F.concat(F.lit('{"signals":['), signal("speed"), F.lit(","), signal("a.b"), F.lit("]}"))
    rows = raw_events(spark, d).where(F.col("type") == fv.TYPE_STATUS).withColumn("data", data)
    even = F.col("id").cast("long") % 2 == 0
    for batch, part in (("even", even), ("odd", ~even), ("odd", ~even)):
        jobs.write_lanes(decode.decode_packed(rows.where(part), CHAIN, CONTRACT, F.col("ingest_time")), target, batch)
    return jobs.read_lanes(spark, target).groupBy("name_token").agg(F.count("*").alias("events"))


MESSAGES = f"""
SELECT concat('{{"id":"', CAST(event_id AS STRING), '","subject":"{DID}', CAST(event_id % 150 AS STRING),
              '","producer":"{DID}', CAST(event_id % 150 + 1000 AS STRING), '","source":"{SOURCE}","type":"',
              CASE WHEN event_id % 31 = 0 THEN 'other.type' ELSE '{fv.TYPE_STATUS}' END,
              '","time":"', ISO(ts), '","data":', CASE WHEN event_id % 37 = 0 THEN '{{' ELSE props END, '}}') AS value,
       ts AS ingest_time, event_id
FROM {{events}}
"""


@query(
    "stream_ingest",
    """SELECT CAST(event_id AS VARCHAR) AS id, epoch_ms(date_trunc('millisecond', ts)) AS time_ms, replace(props, ' ', '') AS data
FROM events WHERE event_id % 31 <> 0 AND event_id % 37 <> 0""",
)
def stream_ingest(spark, d):
    """The given events as a stream of message files out of arrival order, every seventh
    sent twice, through parse, validation, the two-minute arrival window and the table."""
    messages = adapt(spark, d, MESSAGES, ("ingest_time",))
    again = messages.where("event_id % 7 = 0").withColumn("ingest_time", F.expr("ingest_time + INTERVAL '30' SECOND"))
    headers = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    source = scratch_path(spark, "messages")
    sent = messages.unionByName(again).select("value", headers.alias("headers"), "ingest_time")
    # Newest first: every later file is far behind the arrival times already seen.
    files = spark.sparkContext.defaultParallelism
    sent.repartitionByRange(2 * files, F.desc("ingest_time")).write.option("maxRecordsPerFile", ROWS_OF_A_FILE).parquet(source)
    table = new_table(spark)
    stream = read_event_stream(spark, source, files)
    query = jobs.ingest_query(stream, table, scratch_path(spark, "checkpoint"), trigger={"availableNow": True})
    query.awaitTermination()
    return dedup_latest(table.read()).select("id", millis("time"), "data")


_SENT = f"""
SELECT event_id, ts AS ingest_time,
       CASE event_id % 5 WHEN 0 THEN 'attestation' WHEN 1 THEN 'payload' WHEN 2 THEN 'attestation' ELSE 'connection' END AS origin,
       CASE event_id % 5
         WHEN 0 THEN concat('{{"id":"', CAST(event_id AS STRING), '","type":"', CASE WHEN event_id % 3 = 0 THEN 'x.other' ELSE '{fv.TYPE_ATTESTATION}' END,
              '","subject":"{DID}1","source":"{SOURCE}","time":"', ISO(ts), '","data":{{"a":1.50}}}}')
         WHEN 2 THEN concat('{{"id":"', CAST(event_id AS STRING), '","type":"{fv.TYPE_TOMBSTONE}","subject":"{DID}1","source":"{SOURCE}","time":"', ISO(ts),
              '","data":{{"voidsId":"', CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(event_id - 2 AS STRING) END, '"}}}}')
         WHEN 1 THEN concat('{{"headers":[{{"id":"', CAST(event_id AS STRING), 'a","type":"{fv.TYPE_STATUS}","subject":"{DID}2","producer":"{DID}3","time":"', ISO(ts),
              '"}},{{"id":"', CAST(event_id AS STRING), 'b","type":"', CASE WHEN event_id % 3 = 0 THEN 'other' ELSE '{fv.TYPE_STATUS}' END,
              '","subject":"{DID}2","producer":"{DID}3","time":"', ISO(ts), '"}}],"data":{{"k":', CAST(event_id AS STRING), '}}}}')
         ELSE concat('{{"type":"{fv.TYPE_STATUS}","subject":"{DID}4","producer":"{DID}3","source":"{SOURCE}","time":"', ISO(ts), '","data":{{"n":1e5,"e":', CAST(event_id AS STRING), '}}}}')
       END AS value
FROM {{events}}
"""


@query(
    "stream_ingest_origins",
    """WITH x AS (SELECT event_id, event_id % 5 AS kind, event_id % 3 = 0 AS bad FROM events)
SELECT 'accepted' AS outcome, CASE kind WHEN 0 THEN 'attestation' WHEN 2 THEN 'tombstone' WHEN 1 THEN 'payload' ELSE 'connection' END AS origin,
       CAST(sum(CASE WHEN kind = 1 THEN 2 ELSE 1 END) AS BIGINT) AS rows, count(DISTINCT event_id) AS events FROM x WHERE NOT bad OR kind > 2 GROUP BY ALL
UNION ALL
SELECT 'rejected', CASE kind WHEN 0 THEN 'attestation' WHEN 2 THEN 'tombstone' ELSE 'payload' END, count(*), count(*) FROM x WHERE bad AND kind < 3 GROUP BY ALL""",
)
def stream_ingest_origins(spark, d):
    """Connections without an id, attestations, tombstones and payloads of two headers in
    one stream: what is accepted and what is set aside make up all that was sent."""
    sent = adapt(spark, d, _SENT, ("ingest_time",))
    pairs = {"origin": F.col("origin"), "caller": F.lit(SOURCE), "signature-valid": F.lit("true")}
    headers = F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*pairs.values()))
    source = scratch_path(spark, "messages")
    # A trigger takes up to a hundred files.
    sent.select("value", headers.alias("headers"), "ingest_time").write.option("maxRecordsPerFile", ROWS_OF_A_FILE // 10).parquet(source)
    table = new_table(spark)
    stream = read_event_stream(spark, source, 100)
    query = jobs.ingest_query(stream, table, scratch_path(spark, "checkpoint"), trigger={"availableNow": True})
    query.awaitTermination()
    kind = (
        F.when(F.col("type") == fv.TYPE_ATTESTATION, "attestation")
        .when(F.col("type") == fv.TYPE_TOMBSTONE, "tombstone")
        .when(F.col("subject").endswith(":2"), "payload")
        .otherwise("connection")
    )
    event = F.when(kind == "payload", F.regexp_extract("id", "[0-9]+", 0)).otherwise(F.col("id"))
    taken = table.read().select(F.lit("accepted").alias("outcome"), kind.alias("origin"), event.alias("event"))
    aside = spark.read.parquet(f"{table.root}/quarantine").where("reject_class IS NOT NULL")
    from_text = F.when(F.col("value").contains("voidsId"), "tombstone").otherwise(F.element_at("headers", "origin"))
    aside = aside.select(F.lit("rejected").alias("outcome"), from_text.alias("origin"), F.col("value").alias("event"))
    return taken.unionByName(aside).groupBy("outcome", "origin").agg(F.count("*").alias("rows"), F.countDistinct("event").alias("events"))
