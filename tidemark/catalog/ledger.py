"""Queries over snapshots, consumers and data files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.common import (
    AS_OF,
    DATA_FILES,
    LATEST_SQL,
    RAW,
    SNAPSHOTS_SQL,
    as_of,
    data_files,
    load,
    millis,
    oracle,
    progress_log,
    raw_events,
    snapshots,
)
from tidemark.operators import consumers, files, reports
from tidemark.plans import lake, maintenance

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# ---- consumers and expiry ---------------------------------------------------

LATEST = f"p AS ({LATEST_SQL})"
SNAPS = f"s AS ({SNAPSHOTS_SQL})"
LIVE = f"updated_at > TIMESTAMP '{AS_OF}' - INTERVAL '60' MINUTE"
# Orders end years before the fixed instant, so retention is counted in years here.
KEEP = 24 * 365 * 24 * 3600
HORIZON = f"TIMESTAMP '{AS_OF}' - {KEEP} * INTERVAL '1' SECOND"


@query(
    "latest_progress",
    f"WITH {LATEST} SELECT consumer, snapshot_id, epoch_ms(updated_at) AS updated_at_ms FROM p",
)
def latest_progress(spark, d):
    latest = consumers.latest_progress(progress_log(spark, d))
    return latest.select("consumer", "snapshot_id", millis("updated_at"))


@query("consumer_floor", f"WITH {LATEST} SELECT coalesce(min(snapshot_id), -1) AS floor FROM p WHERE {LIVE}")
def consumer_floor(spark, d):
    floor = consumers.consumer_floor(consumers.latest_progress(progress_log(spark, d)), as_of())
    return floor.select(F.coalesce("floor", F.lit(-1).cast("long")).alias("floor"))


@query(
    "stale_consumers",
    f"WITH {LATEST} SELECT consumer, snapshot_id, CAST(epoch(TIMESTAMP '{AS_OF}') - epoch(updated_at) AS BIGINT) AS age_seconds FROM p WHERE NOT ({LIVE})",
)
def stale_consumers(spark, d):
    stale = consumers.stale_consumers(consumers.latest_progress(progress_log(spark, d)), as_of())
    return stale.withColumn("age_seconds", F.col("age_seconds").cast("long"))


_CUTOFF_SQL = f"""f AS (SELECT min(snapshot_id) AS floor FROM p WHERE {LIVE}),
b AS (SELECT min(snapshot_time) AS bound FROM s, f WHERE snapshot_id > floor),
c AS (SELECT least(coalesce(bound, {HORIZON}), {HORIZON}) AS cutoff, floor, coalesce(bound < {HORIZON}, false) AS floor_binding FROM b, f)"""


def _cutoff(spark, d):
    progress = consumers.latest_progress(progress_log(spark, d))
    return consumers.expire_cutoff(snapshots(spark, d), progress, as_of(), keep=KEEP)


@query(
    "expire_cutoff",
    f"WITH {LATEST}, {SNAPS}, {_CUTOFF_SQL} SELECT epoch_ms(cutoff) AS cutoff_ms, floor, floor_binding FROM c",
)
def expire_cutoff(spark, d):
    return _cutoff(spark, d).select(millis("cutoff"), "floor", "floor_binding")


@query(
    "unconsumed_expiring",
    f"""WITH {LATEST}, {SNAPS}, z AS (SELECT consumer, snapshot_id FROM p WHERE NOT ({LIVE}))
SELECT z.consumer, z.snapshot_id, (SELECT count(*) FROM s WHERE s.snapshot_id > z.snapshot_id AND s.snapshot_time < {HORIZON}) AS lost_snapshots FROM z""",
)
def unconsumed_expiring(spark, d):
    stale = consumers.stale_consumers(consumers.latest_progress(progress_log(spark, d)), as_of())
    horizon = as_of() - F.make_dt_interval(secs=F.lit(KEEP))
    return consumers.unconsumed_expiring(snapshots(spark, d), stale, horizon)


@query(
    "expire_snapshots",
    f"WITH {LATEST}, {SNAPS}, {_CUTOFF_SQL} SELECT snapshot_id, epoch_ms(snapshot_time) AS snapshot_time_ms FROM s, c WHERE snapshot_time >= cutoff",
)
def expire_snapshots(spark, d):
    cutoff = _cutoff(spark, d).select("cutoff").scalar()
    return consumers.expire_snapshots(snapshots(spark, d), cutoff).select("snapshot_id", millis("snapshot_time"))


@query(
    "oldest_snapshot_age",
    f"SELECT CAST(epoch(TIMESTAMP '{AS_OF}') - epoch(min(o_orderdate)) AS BIGINT) AS age_seconds FROM orders",
)
def oldest_snapshot_age(spark, d):
    age = consumers.oldest_snapshot_age(snapshots(spark, d), as_of())
    return age.select(F.col("age_seconds").cast("long").alias("age_seconds"))


# ---- files ------------------------------------------------------------------

FILES = f"d AS ({oracle(DATA_FILES)})"


def _registered(rows):
    return rows.where("line <= 3")


@query("new_files", f"WITH {FILES} SELECT path FROM d WHERE line > 3")
def new_files(spark, d):
    rows = data_files(spark, d)
    return files.new_files(rows, _registered(rows)).select("path")


@query(
    "prefix_status",
    f"""WITH {FILES}, x AS (SELECT concat('lake/', flag, '/') AS prefix, count(*) AS files, count(*) FILTER (line <= 3) AS registered FROM d GROUP BY 1)
SELECT *, CASE WHEN registered = 0 THEN 'new' WHEN registered = files THEN 'done' ELSE 'partial' END AS status FROM x""",
)
def prefix_status(spark, d):
    rows = data_files(spark, d)
    return files.prefix_status(rows, _registered(rows))


@query(
    "registration_batches",
    f"""WITH {FILES}, n AS (SELECT path, flag, row_number() OVER (PARTITION BY flag ORDER BY path) AS file_number FROM d WHERE line > 3)
SELECT path, concat('lake/', flag, '/') AS prefix, file_number, CAST(floor((file_number - 1) / 500) AS BIGINT) AS batch FROM n""",
)
def registration_batches(spark, d):
    rows = data_files(spark, d)
    return files.registration_batches(files.new_files(rows, _registered(rows)).select("path"), 500)


TARGET = 64 << 20
LIMIT = 6


@query(
    "plan_compaction",
    f"""WITH {FILES}, w AS (SELECT path, flag, day, bytes, sum(bytes) OVER o - bytes AS before, row_number() OVER o AS n FROM d
  WHERE bytes < {TARGET} WINDOW o AS (PARTITION BY flag, day ORDER BY path)),
g AS (SELECT *, CAST(floor(before / {TARGET}) AS BIGINT) AS size_slot, CAST(floor((n - 1) / {LIMIT}) AS BIGINT) AS count_slot FROM w),
z AS (SELECT *, count(*) OVER (PARTITION BY flag, day, size_slot, count_slot) AS group_files,
             CAST(sum(bytes) OVER (PARTITION BY flag, day, size_slot, count_slot) AS BIGINT) AS group_bytes FROM g)
SELECT path, size_slot, count_slot, group_files, group_bytes FROM z WHERE group_files > 1""",
)
def plan_compaction(spark, d):
    plan = files.plan_compaction(data_files(spark, d), ["flag", "day"], TARGET, LIMIT)
    return plan.select("path", "size_slot", "count_slot", "group_files", "group_bytes")


@query(
    "orphan_files",
    f"WITH {FILES} SELECT path FROM d WHERE line > 3 AND modified < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL '7' DAY",
)
def orphan_files(spark, d):
    rows = data_files(spark, d)
    at = F.lit("2000-01-01 00:00:00").cast("timestamp")
    return files.orphan_files(rows, _registered(rows), at).select("path")


@query(
    "unreferenced_files",
    f"WITH {FILES} SELECT path, removed_snapshot FROM d WHERE removed_snapshot <= (SELECT min(added_snapshot) FROM d WHERE added_snapshot > (SELECT max(added_snapshot) / 2 FROM d))",
)
def unreferenced_files(spark, d):
    rows = data_files(spark, d)
    top = rows.agg(F.max("added_snapshot"))
    retained = rows.select(F.col("added_snapshot").alias("snapshot_id")).where(
        F.col("snapshot_id") > top.scalar() / 2
    )
    return files.unreferenced_files(rows, retained).select("path", "removed_snapshot")


def _marks(spark, d):
    """Deleted row numbers: the first third of a file's rows, a few marked twice."""
    rows = data_files(spark, d)
    index = F.explode_outer(F.sequence(F.lit(1), F.col("line") * 4)).alias("row_index")
    marks = rows.select("path", index)
    return rows, marks.unionByName(marks.where("row_index <= 2"))


@query(
    "delete_heavy_files",
    f"""WITH {FILES} SELECT path, CAST(line * 4 AS BIGINT) AS deleted_rows FROM d WHERE line * 4 >= 0.5 * "rows" """,
)
def delete_heavy_files(spark, d):
    rows, marks = _marks(spark, d)
    return files.delete_heavy(rows, marks).select("path", "deleted_rows")


@query(
    "file_backlog",
    f"""WITH {FILES} SELECT table_name, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS total_bytes,
CAST(floor(sum(bytes) / count(*)) AS BIGINT) AS average_bytes FROM d GROUP BY 1""",
)
def file_backlog(spark, d):
    backlog = files.file_backlog(data_files(spark, d))
    return backlog.withColumn("average_bytes", F.floor("average_bytes").cast("long"))


@query(
    "merge_group_limit",
    f"""WITH {FILES}, b AS (SELECT max(floor(a)) AS avg_bytes FROM (SELECT sum(bytes) / count(*) AS a FROM d GROUP BY table_name) x)
SELECT CAST(least(greatest(floor(536870912 / avg_bytes), 1), 1000) AS BIGINT) AS derived, CAST(256 AS BIGINT) AS fallback, CAST(1000 AS BIGINT) AS pinned FROM b""",
)
def merge_group_limit(spark, d):
    backlog = files.file_backlog(data_files(spark, d))
    limit = lambda **k: files.merge_group_limit(backlog, **k).scalar()
    return backlog.agg(F.count("*").alias("_n")).select(
        limit(memory_limit="1GB").alias("derived"),
        limit(memory_limit="80%").alias("fallback"),
        limit(memory_limit="1GB", pin=5000).alias("pinned"),
    )


@query(
    "restore_gap",
    f"""WITH {FILES} SELECT path, CASE WHEN modified > TIMESTAMP '1998-01-01 00:00:00' THEN 'after_restore_point' ELSE 'before_restore_point' END AS class
FROM d WHERE line > 3""",
)
def restore_gap(spark, d):
    rows = data_files(spark, d)
    at = F.lit("1998-01-01 00:00:00").cast("timestamp")
    return files.restore_gap(rows, _registered(rows), at).select("path", "class")


@query(
    "list_objects",
    """SELECT url AS key, CAST(strlen(html) AS BIGINT) AS size FROM pages
WHERE starts_with(url, 'http://t') AND NOT regexp_matches(url, '(^|/)\\.')""",
)
def list_objects(spark, d):
    pages = load(spark, d, "pages").select(
        F.col("url").alias("key"), F.octet_length("html").cast("long").alias("size")
    )
    return files.listing_order(files.visible_objects(pages, "http://t"))


@query(
    "storage_report",
    f"""WITH {FILES} SELECT flag, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum("rows") AS BIGINT) AS events,
CAST(floor(sum(bytes) / sum("rows")) AS BIGINT) AS bytes_per_event FROM d GROUP BY 1""",
)
def storage_report(spark, d):
    out = reports.storage_report(data_files(spark, d), "flag")
    return out.withColumn("bytes_per_event", F.floor("bytes_per_event").cast("long"))


# ---- change feed and time travel by column ----------------------------------

R = f"raw AS ({oracle(RAW)})"


@query("read_changes", f"WITH {R} SELECT id, snapshot_id FROM raw WHERE snapshot_id BETWEEN 10 AND 40")
def read_changes(spark, d):
    return lake.read_changes(raw_events(spark, d), 10, 40).select("id", "snapshot_id")


_DELETES = "SELECT subject, id, snapshot_id + 20 AS delete_snapshot_id FROM raw WHERE CAST(id AS BIGINT) % 5 < 3 AND snapshot_id % 2 = 0"


@query(
    "read_as_of",
    f"""WITH {R}, x AS ({_DELETES})
SELECT id, snapshot_id FROM raw WHERE snapshot_id <= 70 AND id NOT IN (SELECT id FROM x WHERE delete_snapshot_id <= 70)""",
)
def read_as_of(spark, d):
    rows = raw_events(spark, d)
    rows.createOrReplaceTempView("ledger_raw")
    deletes = spark.sql(_DELETES.replace("FROM raw", "FROM ledger_raw"))
    return lake.read_as_of(rows, deletes, 70, ["subject", "id"]).select("id", "snapshot_id")


# ---- health -----------------------------------------------------------------


@query(
    "health_report",
    f"""WITH {LATEST}, {SNAPS}, {FILES}, {_CUTOFF_SQL},
z AS (SELECT consumer, snapshot_id FROM p WHERE NOT ({LIVE})),
l AS (SELECT consumer, (SELECT count(*) FROM s, c WHERE s.snapshot_id > z.snapshot_id AND s.snapshot_time < c.cutoff) AS n FROM z)
SELECT 'stale_consumers' AS "check", '' AS "key", CAST(count(*) AS BIGINT) AS "value", count(*) > 0 AS breached FROM z
UNION ALL SELECT 'floor_binding', '', CAST(floor_binding AS BIGINT), floor_binding FROM c
UNION ALL SELECT 'oldest_snapshot_age', '', CAST(epoch(TIMESTAMP '{AS_OF}') - epoch(min(snapshot_time)) AS BIGINT), true FROM s
UNION ALL SELECT 'data_files', table_name, count(*), count(*) > 20000 FROM d GROUP BY table_name
UNION ALL SELECT 'average_file_bytes', table_name, CAST(floor(sum(bytes) / count(*)) AS BIGINT), false FROM d GROUP BY table_name
UNION ALL SELECT 'unconsumed_loss', consumer, n, n > 0 FROM l""",
)
def health_report(spark, d):
    progress = consumers.latest_progress(progress_log(spark, d))
    report = maintenance.health_report(
        snapshots(spark, d), progress, data_files(spark, d), as_of(), retention=KEEP
    )
    return report.withColumn("value", F.col("value").cast("long"))
