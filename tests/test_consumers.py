"""Cursors, floor and cutoff on hand-written ledgers."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import consumers

NOW = datetime(2026, 6, 10)
HOUR = timedelta(hours=1)


def ledger(spark, times):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(times)], "snapshot_id long, snapshot_time timestamp")


def log(spark, rows):
    return spark.createDataFrame(rows, schemas.CONSUMER_PROGRESS)


def at():
    return F.lit(NOW)


def test_upsert_keeps_the_last_report(spark):
    rows = [("a", 3, NOW - HOUR), ("a", 5, NOW), ("b", 9, NOW - HOUR)]
    got = {r.consumer: r.snapshot_id for r in consumers.latest_progress(log(spark, rows)).collect()}
    assert got == {"a": 5, "b": 9}


def test_floor_ignores_stale_and_is_null_without_live(spark):
    rows = log(spark, [("a", 7, NOW - timedelta(minutes=5)), ("b", 2, NOW - HOUR)])
    assert consumers.consumer_floor(rows, at()).first().floor == 7
    assert [r.consumer for r in consumers.stale_consumers(rows, at()).collect()] == ["b"]
    assert consumers.stale_consumers(rows, at()).first().age_seconds == 3600.0
    assert consumers.consumer_floor(rows.where("consumer = 'b'"), at()).first().floor is None


def test_cutoff_cases(spark):
    old = ledger(spark, [NOW - timedelta(days=9 - i) for i in range(6)])
    horizon = NOW - timedelta(hours=72)

    def cutoff(rows):
        r = consumers.expire_cutoff(old, log(spark, rows), at()).first()
        return r.cutoff, r.floor, r.floor_binding

    assert cutoff([]) == (horizon, None, False)
    assert cutoff([("a", 2, NOW)]) == (NOW - timedelta(days=7), 2, True)
    # Caught up to the head, or far enough: retention alone decides.
    assert cutoff([("a", 6, NOW)]) == (horizon, 6, False)
    assert cutoff([("a", 2, NOW), ("slow", 0, NOW)]) == (NOW - timedelta(days=9), 0, True)


def test_newest_snapshot_always_stays(spark):
    old = ledger(spark, [NOW - timedelta(days=9 - i) for i in range(3)])
    assert [r.snapshot_id for r in consumers.expire_snapshots(old, at()).collect()] == [3]


def test_unconsumed_loss_counts_only_expiring(spark):
    old = ledger(spark, [NOW - timedelta(days=9 - i) for i in range(6)])
    stale = spark.createDataFrame([("x", 1), ("y", 4), ("z", 0), ("w", 99)], "consumer string, snapshot_id long")
    got = consumers.unconsumed_expiring(old, stale, F.lit(NOW - timedelta(days=5)))
    assert {r.consumer: r.lost_snapshots for r in got.collect()} == {"x": 3, "y": 0, "z": 4, "w": 0}
