"""Queries over a real table while it is written: consumers, bundles, counts, state."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.catalog.common import CHAIN, CONTRACT, RAW, adapt, load, millis, oracle, raw_events
from tidemark.catalog.events import ORACLES as EVENT_ORACLES
from tidemark.catalog.signals import ORACLES as SIGNAL_ORACLES
from tidemark.catalog.signals import signal_rows, status_events
from tidemark.catalog.table import _SENT, MESSAGES, ROWS_OF_A_FILE, ORACLES as TABLE_ORACLES, SOURCE, complete, new_table
from tidemark.functions import identity
from tidemark.operators import decode, ordered
from tidemark.operators.dedup import dedup_latest
from tidemark.plans import lake
from tidemark.plans.addresses import ADDRESSES, AddressDimension
from tidemark.plans.rollup import LatestTable
from tidemark.session import scratch_path
from tidemark.sources.tables import read_event_stream
from tidemark.streaming import jobs
from tidemark.streaming.bundles import Bounds, Bundles
from tidemark.streaming.consume import consume
from tidemark.streaming.rescale import NotDrained, switch
from tidemark.streaming.silence import silence_stream
from tidemark.streaming.throttle import throttle_stream, use_rocksdb

QUERIES: dict = {}
ORACLES: dict = {}

R = f"raw AS ({oracle(RAW)})"
ONCE = {"availableNow": True}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def finished(started) -> None:
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


# ---- change feed and cursors


def overtaken_table(spark, d):
    """Rows of odd ids are written first and committed last: rows of even ids, written and
    committed in between, overtake them."""
    table = new_table(spark)
    rows = complete(raw_events(spark, d))
    even = F.col("id").cast("long") % 2 == 0
    slow = table.prepare(rows.where(~even).withColumn("batch", F.lit("slow")), ["slow"])
    table.write(rows.where(even), "fast")
    return table, slow


@query(
    "consume_overtaking_writers",
    """SELECT CAST(event_id AS VARCHAR) AS id, 1 + event_id % 2 AS run, 1 + event_id % 2 AS snapshot_id FROM events""",
)
def consume_overtaking_writers(spark, d):
    """A consumer runs before and after the slow writer commits; every row is seen once."""
    table, slow = overtaken_table(spark, d)
    seen, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "checkpoint")

    def keep(rows, name):
        rows.select("id", "snapshot_id").write.mode("overwrite").parquet(f"{seen}/batch={name}")

    for attempt in (None, *slow):
        if attempt is not None:
            table.commit(**attempt)
        finished(consume(table, "reader", keep, checkpoint, trigger=ONCE))
    batch = F.regexp_extract("batch", "-([0-9]+)$", 1).cast("long")
    return spark.read.parquet(seen).select("id", (batch + 1).alias("run"), "snapshot_id")


@query(
    "read_changes_of_table",
    f"WITH {R} SELECT id, 1 + CAST(id AS BIGINT) % 2 AS snapshot_id, data FROM raw WHERE CAST(id AS BIGINT) % 2 = 1",
)
def read_changes_of_table(spark, d):
    """A reader of all snapshots up to the first comes back for those after it."""
    table, slow = overtaken_table(spark, d)
    upto = table.last_snapshot()
    for attempt in slow:
        table.commit(**attempt)
    return lake.read_changes(table.read(), upto + 1, table.last_snapshot()).select("id", "snapshot_id", "data")


@query(
    "decode_table_lanes",
    "SELECT 'speed' AS name_token, count(*) AS events FROM events WHERE event_type = 'click' UNION ALL SELECT 'a_b', count(*) FROM events WHERE event_type = 'click'",
)
def decode_table_lanes(spark, d):
    """The table decoded commit by commit, in two runs, one commit at a time."""
    table = new_table(spark)
    stamp = F.date_format("ingest_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    element = lambda n: F.concat(F.lit(f'{{"name":"{n}","timestamp":"'), stamp, F.lit('","value":1}'))
    data = F.concat(F.lit('{"signals":['), element("speed"), F.lit(","), element("a.b"), F.lit("]}"))
    rows = complete(raw_events(spark, d)).withColumn("data", data)
    target, checkpoint = scratch_path(spark, "lanes"), scratch_path(spark, "checkpoint")
    for part in range(3):
        table.write(rows.where(F.col("id").cast("long") % 3 == part), f"part-{part}")
        if part != 1:
            finished(jobs.decode_table(table, target, checkpoint, CHAIN, CONTRACT, trigger=ONCE, max_commits=1))
    return jobs.read_lanes(spark, target).groupBy("name_token").agg(F.count("*").alias("events"))


@query(
    "point_read",
    f"""WITH {R} SELECT id, subject, epoch_ms(time) AS time_ms FROM raw WHERE type = '{fv.TYPE_STATUS}' AND CAST(id AS BIGINT) % 150 = 7
AND time >= TIMESTAMP '2024-01-05 00:00:00' AND time < TIMESTAMP '2024-01-20 00:00:00'""",
)
def point_read(spark, d):
    """One subject over two weeks from a table of several commits."""
    table = new_table(spark)
    rows = complete(raw_events(spark, d))
    subject = rows.where(F.col("id").cast("long") % 150 == 7).agg(F.min("subject")).first()[0]
    for part in range(3):
        table.write(rows.where(F.col("id").cast("long") % 3 == part), f"part-{part}", layout="range")
    found = table.read(fv.TYPE_STATUS, datetime(2024, 1, 5), datetime(2024, 1, 20), subject=subject)
    return found.select("id", "subject", millis("time"))


# ---- ingest with bounds and counts


@query(
    "stream_ingest_bundles",
    """WITH x AS (SELECT count(*) AS n FROM events WHERE event_id % 31 <> 0 AND event_id % 37 <> 0)
SELECT n AS events, true AS files_bounded, 2 AS snapshots, CAST(0 AS BIGINT) AS waiting FROM x""",
)
def stream_ingest_bundles(spark, d):
    """Two micro-batches too small for a bundle: nothing is committed before the hard age
    is reached, then both at once; two more are written at the end."""
    messages = adapt(spark, d, MESSAGES, ("ingest_time",)).withColumn("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    table, checkpoint, source = new_table(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "messages")
    bounds = Bounds(rows=500, bytes=1 << 20, soft_bytes=1 << 40, hard_seconds=3600)
    late = F.col("event_id") % 5 == 4
    files = spark.sparkContext.defaultParallelism
    for part, at_once in ((~late, False), (late, True)):
        messages.where(part).select("value", "headers", "ingest_time").repartition(2 * files).write.option("maxRecordsPerFile", ROWS_OF_A_FILE).mode("append").parquet(source)
        stream = read_event_stream(spark, source, files)
        finished(jobs.ingest_query(stream, table, checkpoint, trigger=ONCE, bounds=bounds))
        if table.last_snapshot() != (1 if at_once else 0):
            raise RuntimeError("a bundle was written too early")
        later = datetime.now(timezone.utc) + timedelta(seconds=0 if at_once else 3601)
        Bundles(table, bounds).flush(later, force=at_once)
    files = table.stored().groupBy("file_path").agg(F.count("*").alias("rows"))
    waiting = len(Bundles(table, bounds).waiting())
    return files.agg(F.sum("rows").alias("events"), (F.max("rows") <= 500).alias("files_bounded")).select(
        "events", "files_bounded", F.lit(table.last_snapshot()).alias("snapshots"), F.lit(waiting).cast("long").alias("waiting")
    )


@query(
    "stream_outcomes",
    """WITH x AS (SELECT event_id % 5 AS kind, event_id % 3 = 0 AS bad FROM events),
y AS (SELECT CASE WHEN kind IN (0, 2) THEN 'attestation' WHEN kind = 1 THEN 'payload' ELSE 'connection' END AS origin,
  CASE WHEN NOT bad OR kind > 2 THEN 'accepted' WHEN kind = 0 THEN 'unsupported_type' WHEN kind = 1 THEN 'unsupported_type' ELSE 'tombstone_voids_id_required' END AS outcome,
  CASE WHEN kind = 1 AND NOT bad THEN 2 ELSE 1 END AS n FROM x)
SELECT origin, outcome, CAST(sum(n) AS BIGINT) AS events FROM y GROUP BY ALL""",
)
def stream_outcomes(spark, d):
    """What became of every event, counted by the stream in two batches and two runs."""
    sent = adapt(spark, d, _SENT, ("ingest_time",))
    pairs = {"origin": F.col("origin"), "caller": F.lit(SOURCE), "signature-valid": F.lit("true")}
    headers = F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*pairs.values()))
    table, checkpoint, source = new_table(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "messages")
    for part in (0, 1):
        rows = sent.where(F.col("event_id") % 2 == part).select("value", headers.alias("headers"), "ingest_time")
        rows.write.option("maxRecordsPerFile", ROWS_OF_A_FILE).mode("append").parquet(source)
        finished(jobs.ingest_query(read_event_stream(spark, source), table, checkpoint, trigger=ONCE))
    return jobs.outcome_counts(table)


# ---- state


@query("throttle_stream", EVENT_ORACLES["throttle_first"])
def throttle_of_stream(spark, d):
    """The limiter as a stateful query; within one micro-batch it is the batch operator."""
    rows = load(spark, d, "events").select(F.col("event_type").alias("producer"), F.col("ts").cast("timestamp").alias("ts"))
    source, out = scratch_path(spark, "messages"), scratch_path(spark, "emitted")
    rows.write.parquet(source)
    use_rocksdb(spark)
    stream = throttle_stream(spark.readStream.schema(rows.schema).parquet(source), "producer", F.col("ts"))
    # Without new rows there is nothing to let through; expired state goes with the next rows.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    finished(
        stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(**ONCE).start(out)
    )
    return spark.read.schema("key string, emitted_ms long").parquet(out).withColumnRenamed("key", "producer")


@query("stream_ingest_replayed", TABLE_ORACLES["stream_ingest"])
def stream_ingest_replayed(spark, d):
    """The stream whose last batch runs again after it was committed to the table."""
    messages = adapt(spark, d, MESSAGES, ("ingest_time",))
    headers = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    table, checkpoint, source = new_table(spark), scratch_path(spark, "checkpoint"), scratch_path(spark, "messages")
    files = spark.sparkContext.defaultParallelism
    messages.select("value", headers.alias("headers"), "ingest_time").repartition(2 * files).write.option("maxRecordsPerFile", ROWS_OF_A_FILE).parquet(source)
    finished(jobs.ingest_query(read_event_stream(spark, source, files), table, checkpoint, trigger=ONCE))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    finished(jobs.ingest_query(read_event_stream(spark, source, files), table, checkpoint, trigger=ONCE))
    rows = table.read()
    if rows.count() != dedup_latest(rows).count():
        raise RuntimeError("a replayed batch was written twice")
    return rows.select("id", millis("time"), "data")


@query("latest_signals_rollup", SIGNAL_ORACLES["latest_signals"])
def latest_signals_rollup(spark, d):
    """The latest signals kept up over five updates out of order, one of them replayed, with
    a merge in between, equal to the computation over everything."""
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    rows = decode.inline_rows(decoded, "signals", "subject")
    latest = LatestTable(spark, scratch_path(spark, "latest"), buckets=4)
    for step, part in enumerate((3, 0, 4, 1, 1, 2)):
        latest.update(rows.where(F.pmod(F.xxhash64("timestamp"), F.lit(5)) == part), f"part-{part}")
        if step == 3:
            latest.merge("merge-1", most_parts=2)
    return latest.read().select("subject", "name", F.unix_micros("timestamp").alias("us"), "pos", "value")


@query("decode_with_parsers", SIGNAL_ORACLES["decode_signals"])
def decode_with_parsers(spark, d):
    """Twenty sources with a parser of their own: one scan, and the rows of the default."""
    rows = status_events(spark, d).withColumn("source", F.concat(F.lit("vendor-"), (F.col("event_id") % 25).cast("string")))
    for i in range(20):
        decode.register_parser(f"vendor-{i}", _like_the_default)
    try:
        decoded = decode.decode_arrays(rows, CHAIN, CONTRACT)
        return decoded.transform(signal_rows).select("event_id", "name", F.unix_micros("timestamp").alias("us"), "pos", "value")
    finally:
        for i in range(20):
            decode.unregister_parser(f"vendor-{i}")


def _like_the_default(text: str):
    for e in json.loads(text).get("signals") or []:
        value = e.get("value")
        yield e.get("name"), e.get("timestamp"), None if value is None else value if isinstance(value, str) else json.dumps(value)


_SERIES_GAP = 12 * 3600

_SILENCES_SQL = f"""WITH t AS (SELECT DISTINCT user_id, epoch_ms(date_trunc('millisecond', ts)) AS ms FROM events),
l AS (SELECT *, lead(ms) OVER (PARTITION BY user_id ORDER BY ms) AS following, (SELECT max(ms) FROM t) - 60000 AS seen FROM t)
SELECT CAST(user_id AS VARCHAR) AS series, ms AS since_ms FROM l WHERE coalesce(following, seen) - ms > {_SERIES_GAP * 1000}"""


@query("silence_stream", _SILENCES_SQL)
def silences_of_stream(spark, d):
    """Series of the given events that stopped for half a day, by event-time timers."""
    rows = load(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    source, out = scratch_path(spark, "messages"), scratch_path(spark, "silences")
    rows.write.parquet(source)
    use_rocksdb(spark)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    stream = silence_stream(spark.readStream.schema(rows.schema).parquet(source), "user_id", "ts", _SERIES_GAP)
    finished(
        stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(**ONCE).start(out)
    )
    return spark.read.schema("series string, since_ms long").parquet(out)


@query(
    "address_dimension",
    "SELECT DISTINCT user_id, true AS as_computed, CAST(0 AS BIGINT) AS learned_again FROM events",
)
def address_dimension(spark, d):
    """Identifiers through a dimension that was learned in two rounds, against the checksum
    computed row by row; a third round learns nothing."""
    users = load(spark, d, "events").select("user_id").distinct()
    digits = F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 40)
    rows = users.select("user_id", F.concat(F.lit("did:erc721:137:0x"), digits, F.lit(":7")).alias("subject"))
    known = AddressDimension(spark, scratch_path(spark, "addresses"))
    for part in (0, 1):
        known.learn(rows.where(F.col("user_id") % 2 <= part), ["subject"], f"round-{part}")
    known.learn(rows, ["subject"], "round-2")
    again = spark.read.schema(ADDRESSES).parquet(f"{known.root}/batch=round-2").count()
    computed = rows.select("user_id", identity.canonical_did(F.col("subject")).alias("computed"))
    joined = known.canonical(rows, ["subject"]).join(computed, "user_id")
    return joined.select("user_id", (F.col("subject") == F.col("computed")).alias("as_computed"), F.lit(again).cast("long").alias("learned_again"))


@query(
    "partition_switch",
    "SELECT user_id, count(*) AS row_count, CAST(0 AS BIGINT) AS order_breaks, true AS refused_first FROM events GROUP BY user_id",
)
def partition_switch(spark, d):
    """A change from 4 to 7 routing partitions: refused while files wait, and without a break
    in the order of any subject once they are drained."""
    events = load(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    first, half = events.agg(F.expr("percentile_approx(event_id, array(0.25, 0.5))")).first()[0]
    out, schema = scratch_path(spark, "routed"), "event_id long, user_id long, ts timestamp, route int"
    old, new = ((scratch_path(spark, "layout"), scratch_path(spark, "checkpoint"), n) for n in (4, 7))

    def send(layout, part):
        source, _, partitions = layout
        routed = events.where(part).withColumn("route", identity.route_partition(F.col("user_id").cast("string"), partitions))
        routed.repartition("route").sortWithinPartitions("event_id").write.mode("append").parquet(source)

    def run(layout):
        source, checkpoint, partitions = layout

        def write(batch, batch_id):
            # When the rows were taken: layouts follow each other, and so do their batches.
            batch.withColumns({"layout": F.lit(partitions), "taken": F.lit(batch_id)}).write.mode("append").parquet(out)

        stream = spark.readStream.schema(schema).parquet(source)
        finished(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**ONCE).start())

    send(old, F.col("event_id") <= first)
    run(old)
    send(old, (F.col("event_id") > first) & (F.col("event_id") <= half))
    send(new, F.col("event_id") > half)
    refused = False
    try:
        switch(spark, old[1], old[0], lambda: run(new))
    except NotDrained:
        refused = True
    run(old)
    switch(spark, old[1], old[0], lambda: run(new))
    rows = spark.read.parquet(out)
    turn = F.col("layout") * 1000 + F.col("taken")
    order = ordered.order_breaks(rows, "user_id", ["layout", "taken", "event_id"], "event_id", turn)
    return order.withColumn("refused_first", F.lit(refused))
