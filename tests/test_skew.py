"""Ordered operators against brute force, with one group holding most rows."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import alerts, dedup, files, ordered
from tidemark.operators.throttle import throttle_first
from tidemark.session import spread

T0 = datetime(2026, 6, 1)


def hot_rows(spark, n=3000, seed=3):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.7 else f"k{rng.randint(1, 9)}", T0 + timedelta(milliseconds=rng.randint(0, 5 * 86_400_000)), i, rng.randint(-5, 20))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k string, ts timestamp, i int, v int").repartition(4)


def check(spark, chunk):
    rows = hot_rows(spark)
    got = ordered.running_stats(
        rows, ["k"], ["ts", "i"], number="n", running={"total": "v"}, previous={"before": "v"}, chunk=chunk, partitions=6
    )
    w = Window.partitionBy("k").orderBy("ts", "i")
    want = rows.withColumns(
        {
            "n": F.row_number().over(w).cast("long"),
            "total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.lag("v").over(w),
        }
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_stats_by_time_chunk(spark):
    check(spark, F.date_trunc("hour", F.col("ts")))


def test_running_stats_by_range_chunk(spark):
    check(spark, None)


def test_global_numbering(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    got = ordered.running_stats(rows, [], ["x"], number="n", partitions=7)
    assert got.where("n <> x + 1").count() == 0 and got.count() == 1000


def test_previous_keeps_null_values(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None)], "k string, t int, v int")
    got = ordered.running_stats(rows, ["k"], ["t"], previous={"p": "v"}, chunk=F.col("t"))
    assert [r.p for r in got.orderBy("t").collect()] == [None, None, 5]


def greedy(times, interval):
    out = []
    for t in sorted(set(times)):
        if not out or t - out[-1] >= interval:
            out.append(t)
    return out


def test_throttle_equals_greedy(spark):
    rows = hot_rows(spark, 4000, 11)
    got = throttle_first(rows, "k", F.col("ts"), 3600)
    by_key = {}
    for r in rows.select("k", F.unix_millis("ts").alias("ms")).collect():
        by_key.setdefault(r.k, []).append(r.ms)
    want = {(k, ms) for k, times in by_key.items() for ms in greedy(times, 3_600_000)}
    assert {(r.k, r.emitted_ms) for r in got.collect()} == want


def test_throttle_exact_interval_is_emitted(spark):
    rows = spark.createDataFrame([("p", T0), ("p", T0 + timedelta(hours=1)), ("p", T0 + timedelta(hours=1, minutes=59))], "k string, ts timestamp")
    assert throttle_first(rows, "k", F.col("ts")).count() == 2


def test_hot_copies_are_reduced(spark):
    rows = spark.range(5000).select(
        F.lit("s").alias("subject"),
        F.lit(T0).alias("time"),
        F.lit("t").alias("type"),
        F.lit("src").alias("source"),
        F.when(F.col("id") < 4000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("snapshot_id"),
    )
    latest = dedup.dedup_latest(rows)
    assert latest.count() == 1001
    assert latest.where("id = 'same'").first().snapshot_id == 3999
    volume = dedup.duplicate_volume(rows).first()
    assert (volume["keys"], volume.duplicates, volume.max_copies) == (1001, 3999, 4000)
    # Each key is reduced before the shuffle.
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_sustained_across_chunks(spark):
    rng = random.Random(5)
    rows = [("s", T0 + timedelta(minutes=7 * i), rng.random() < 0.8) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, ts timestamp, on boolean")
    want, start = [], None
    for (_, ts, on), nxt in zip(rows, [*rows[1:], ("", None, False)]):
        start = (start or ts) if on else None
        if on and not nxt[2] and (ts - start).total_seconds() >= 1800:
            want.append((start, ts))
    got = alerts.sustained(df, "s", "ts", F.col("on"), 1800)
    assert sorted((r.started, r.ended) for r in got.collect()) == want


def test_counter_reset(spark):
    rows = [("s", T0 + timedelta(seconds=30 * i), v) for i, v in enumerate([5, 9, 2, 4])]
    df = spark.createDataFrame(rows, "s string, ts timestamp, v long")
    assert alerts.counter_increase(df, "s", "ts", "v").first().increase == 4 + 2 + 2


def test_unless(spark):
    failures = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "pod string, n int")
    commits = spark.createDataFrame([("b", 2), ("a", 0)], "pod string, n int")
    got = alerts.failing_unless_committing(failures, commits, "pod", "n")
    assert [(r.pod, r.failures) for r in got.collect()] == [("a", 3)]


def test_backlog_growth_takes_one_step_a_sample(spark):
    """Against a search over all samples, with ties, gaps, bounds met exactly and missing
    counts; and no frame that moves over the samples, which costs the square of a chunk."""
    rng, hours, span = random.Random(5), 2, 7_200_000_000
    times = [rng.randrange(12) * 1_800_000_000 - rng.randrange(2) for _ in range(80)] + [40 * span, 40 * span + 1]
    rows = [(f"t{i % 2}", us, None if i % 17 == 0 else rng.randrange(9)) for i, us in enumerate(times)]
    samples = spark.createDataFrame(rows, "t string, us long, n long").withColumn("ts", F.timestamp_micros("us"))
    grown = alerts.backlog_growing(samples, "t", "ts", "n", hours, threshold=4)
    got = sorted(map(repr, grown.select("t", F.unix_micros("ts"), "current_files", "growth", "breached").collect()))

    def line(t, us, n):
        held = [(u, m is not None, m) for s, u, m in rows if s == t and us - span <= u <= us]
        first = min(held, key=lambda h: (h[0], h[1], h[2] or 0))[2]
        growth = None if n is None or first is None else n - first
        high, more = None if n is None else n > 4, None if growth is None else growth > 0
        both = False if high is False or more is False else None if high is None or more is None else True
        return (t, us, n, growth, both)

    want = sorted(map(repr, spark.createDataFrame([line(*r) for r in rows], "t string, `unix_micros(ts)` long, current_files long, growth long, breached boolean").collect()))
    assert got == want
    assert "RangeFrame" not in grown._jdf.queryExecution().executedPlan().toString()


def test_deleted_rows_are_counted_in_words(spark):
    """Repeated marks count once, also at the borders of words; nothing is grouped by row."""
    rng = random.Random(8)
    marks = [(f"f{i % 3}", rng.choice([0, 1, 62, 63, 64, 127, 128, 1 << 40, rng.randrange(500)])) for i in range(600)] + [("f1", None)] * 2
    sizes = spark.createDataFrame([(f"f{i}", 150) for i in range(4)], "path string, rows long")
    out = files.delete_fractions(sizes, spark.createDataFrame(marks, "path string, row_index long").repartition(3))
    want = {f"f{i}": len({r for p, r in marks if p == f"f{i}"}) for i in range(3)}
    assert {r.path: r.deleted_rows for r in out.collect()} == want
    assert "row_index" not in " ".join(re.findall(r"keys=\[[^\]]*\]", out._jdf.queryExecution().executedPlan().toString()))


def test_spread_grows_with_the_rows(spark):
    few, many = (spread(spark.range(n), 100).rdd.getNumPartitions() for n in (50, 1001))
    assert (few, many) == (spark.sparkContext.defaultParallelism, 11)
