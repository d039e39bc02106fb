"""Queries for the health rules: the given events stand in for metric samples, with
the event type as the series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.common import AS_OF, as_of, load
from tidemark.operators import alerts

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def samples(spark, d):
    return load(spark, d, "events").select(
        F.col("event_type").alias("series"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * 100).cast("long").alias("value"),
        "user_id",
    )


SAMPLES = "m AS (SELECT event_type AS series, ts, epoch_us(ts) AS us, CAST(floor(value * 100) AS BIGINT) AS value, user_id FROM events)"


@query(
    "backlog_growing",
    f"""WITH {SAMPLES}, w AS (SELECT series, us, value, value - first(value) OVER (
  PARTITION BY series ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW) AS growth FROM m)
SELECT series, us, value AS current_files, growth, value > 4000 AND growth > 0 AS breached FROM w""",
)
def backlog_growing(spark, d):
    out = alerts.backlog_growing(samples(spark, d), "series", "ts", "value", threshold=4000)
    return out.withColumn("us", F.unix_micros("ts")).drop("ts")


@query(
    "counter_increase",
    f"""WITH {SAMPLES}, w AS (SELECT *, us // 900000000 * 900 AS window_start FROM m),
l AS (SELECT *, lag(value) OVER (PARTITION BY series, window_start ORDER BY us) AS before FROM w)
SELECT series, window_start, CAST(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) AS BIGINT) AS increase
FROM l GROUP BY ALL""",
)
def counter_increase(spark, d):
    out = alerts.counter_increase(samples(spark, d), "series", "ts", "value")
    return out.withColumn("window_start", F.unix_seconds("window_start"))


@query(
    "heartbeat_gaps",
    f"""WITH {SAMPLES}, l AS (SELECT series, lag(us) OVER (PARTITION BY series ORDER BY us) AS gap_start, us AS gap_end FROM m
UNION ALL SELECT series, max(us), epoch_us(TIMESTAMP '{AS_OF}') FROM m GROUP BY series)
SELECT series, gap_start, gap_end FROM l WHERE gap_end - gap_start > 900000000""",
)
def heartbeat_gaps(spark, d):
    out = alerts.heartbeat_gaps(samples(spark, d), "series", "ts", as_of())
    return out.select("series", F.unix_micros("gap_start").alias("gap_start"), F.unix_micros("gap_end").alias("gap_end"))


@query(
    "cycle_stalled",
    f"""WITH {SAMPLES} SELECT user_id, CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - max(us)) / 1000000) AS BIGINT) AS age_seconds
FROM m GROUP BY 1 HAVING epoch_us(TIMESTAMP '{AS_OF}') - max(us) > 172800000000""",
)
def cycle_stalled(spark, d):
    out = alerts.cycle_stalled(samples(spark, d), "user_id", "ts", as_of(), 2 * 86400)
    return out.withColumn("age_seconds", F.floor("age_seconds").cast("long"))


@query(
    "sustained_condition",
    f"""WITH {SAMPLES}, c AS (SELECT series, us, value > 1000 AS held FROM m),
f AS (SELECT *, CASE WHEN lag(held) OVER o = held THEN 0 ELSE 1 END AS flip FROM c WINDOW o AS (PARTITION BY series ORDER BY us)),
i AS (SELECT *, sum(flip) OVER (PARTITION BY series ORDER BY us) AS island FROM f),
g AS (SELECT series, min(us) AS started, max(us) AS ended FROM i WHERE held GROUP BY series, island)
SELECT series, started, ended FROM g WHERE ended - started >= 1800000000""",
)
def sustained_condition(spark, d):
    out = alerts.sustained(samples(spark, d), "series", "ts", F.col("value") > 1000, 1800)
    return out.select("series", F.unix_micros("started").alias("started"), F.unix_micros("ended").alias("ended"))


@query(
    "failing_unless_committing",
    f"""WITH {SAMPLES}, p AS (SELECT concat(user_id, '@', CAST(CAST(ts AS DATE) AS VARCHAR)) AS pod, series, value FROM m)
SELECT pod, CAST(sum(value) AS BIGINT) AS failures FROM p WHERE series = 'error' AND pod NOT IN (
  SELECT pod FROM p WHERE series = 'purchase' GROUP BY pod HAVING sum(value) > 0) GROUP BY pod HAVING sum(value) > 0""",
)
def failing_unless_committing(spark, d):
    day = F.to_date("ts").cast("string")
    rows = samples(spark, d).withColumn("pod", F.concat_ws("@", F.col("user_id").cast("string"), day))
    return alerts.failing_unless_committing(
        rows.where("series = 'error'"), rows.where("series = 'purchase'"), "pod", "value"
    )
