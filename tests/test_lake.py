"""The table: layout, reads, backfill, crash behaviour, decoded lanes."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark import schemas
from tidemark.operators import files, reports
from tidemark.plans import lake, maintenance
from tidemark.plans.lake import RawEventTable

T0 = datetime(2026, 6, 1)


def events(spark, n=20, start=0, day=0, type=fv.TYPE_STATUS):
    rows = [
        (f"did:erc721:137:0xA:{i % 5}", T0 + timedelta(days=day, seconds=i), type, str(start + i), '{"v":1}')
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "subject string, time timestamp, type string, id string, data string")
    present = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schemas.RAW_EVENTS.fields if f.name not in present}
    ).select(*schemas.RAW_EVENT_COLUMNS)


@pytest.fixture
def table(spark, tmp_path):
    return RawEventTable(spark, str(tmp_path / "lake"))


def ids(rows):
    return sorted(int(r.id) for r in rows.select("id").collect())


def files_of(spark, table):
    rows = spark.read.schema(schemas.TABLE_ROWS).parquet(table.data)
    found = rows.groupBy("type", "year", "month", "day", F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))
    return found.collect()


def test_layout_one_file_per_type_and_day(spark, table):
    rows = events(spark).unionByName(events(spark, day=1, start=100)).unionByName(
        events(spark, day=1, start=200, type=fv.TYPE_FINGERPRINT)
    )
    table.write(rows, "a", T0)
    found = files_of(spark, table)
    assert len(found) == 3 and sum(r.rows for r in found) == 60
    assert {(r.year, r.month, r.day) for r in found} == {(2026, 6, 1), (2026, 6, 2)}
    assert reports.layout_audit(table.stored()).where("unsorted_rows > 0 OR misplaced_rows > 0").count() == 0


def test_empty_table_and_empty_write(spark, table):
    assert table.read().count() == 0
    table.write(events(spark).limit(0), "a", T0)
    table.write(events(spark), "b", T0)
    assert table.read().count() == 20


def test_a_batch_replaces_itself_and_nothing_else(spark, table):
    table.write(events(spark), "a", T0)
    table.write(events(spark, start=100), "b", T0)
    table.write(events(spark, start=100), "b", T0)
    assert ids(table.read()) == [*range(20), *range(100, 120)]
    assert ids(lake.read_changes(table.read(), 2, 2)) == list(range(100, 120))


def test_a_write_stopped_half_way_leaves_the_committed_rows(spark, table):
    table.write(events(spark), "a", T0)
    fails = events(spark, start=100).withColumn(
        "data", F.when(F.col("id") == "113", F.raise_error(F.lit("disk is gone"))).otherwise(F.col("data"))
    )
    with pytest.raises(Exception, match="disk is gone"):
        table.write(fails, "b", T0)
    assert ids(table.read()) == list(range(20))
    table.write(events(spark, 5, start=100), "b", T0)
    assert ids(table.read()) == [*range(20), *range(100, 105)]


def test_special_characters_in_types(spark, table):
    odd = "raw.a b:c+d/e%"
    table.write(events(spark, type=odd), "a", T0)
    assert table.read(odd).count() == 20 and {r.type for r in table.read().collect()} == {odd}


def test_codec_and_row_cap_apply(spark, table):
    table.write(events(spark, 50), "a", T0, **lake.write_options("uncompressed", target_bytes=1000, row_bytes=100))
    assert max(r.rows for r in files_of(spark, table)) == 10


def test_quarantine_keeps_headers_and_tags(spark, tmp_path):
    rows = spark.createDataFrame([("x", {"a": "b"}, ["t"], "undecodable")], "value string, headers map<string,string>, tags array<string>, reject_reason string")
    lake.quarantine(rows, str(tmp_path / "q"))
    kept = spark.read.parquet(str(tmp_path / "q")).first()
    assert kept.headers == {"a": "b"} and kept.tags == ["t"] and kept.reject_reason == "undecodable"


def test_decoded_batches_are_clustered_and_replay_safe(spark, tmp_path):
    schema = "dedup_id string, v int, lane string, d date"
    d1, d2 = T0.date(), (T0 + timedelta(days=1)).date()
    target = str(tmp_path / "decoded")
    rows = [(f"{i % 30}", i % 30, "xy"[i % 2], (d1, d2)[i % 2]) for i in range(60)]
    new = spark.createDataFrame(rows, schema).repartition(8)
    for _ in range(2):
        lake.append_decoded(new, target, "one", ["dedup_id"], "d", ("lane",))
    more = spark.createDataFrame([("3", 3, "y", d2), ("99", 1, "x", d1)], schema)
    lake.append_decoded(more, target, "two", ["dedup_id"], "d", ("lane",), seen=spark.read.parquet(target).where("d >= DATE '2026-06-01'"))
    stored = spark.read.parquet(target)
    assert sorted(int(r.dedup_id) for r in stored.collect()) == [*range(30), 99]
    assert stored.where("batch = 'one'").select(F.input_file_name()).distinct().count() == 2


def test_reads_prune_partitions(spark, table):
    table.write(events(spark).unionByName(events(spark, day=1, start=100)), "a", T0)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rows = table.read(fv.TYPE_STATUS, T0, T0 + timedelta(hours=1), subject="did:erc721:137:0xA:1")
    assert ids(rows) == [1, 6, 11, 16]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "type" in partition_filters and "year" in partition_filters
    assert "EqualTo(subject" in plan


def bundle_folder(spark, root, days=2, files_per_day=2):
    n = 0
    for day in range(days):
        for i in range(files_per_day):
            rows = events(spark, 10, start=1000 * n, day=day).unionByName(events(spark, 5, start=1000 * n + 500, day=day, type=fv.TYPE_FINGERPRINT))
            rows.drop("voids_id").coalesce(1).write.parquet(f"{root}/2026/05/{day:02d}/batch-{i}")
            n += 1
    with open(f"{root}/2026/05/00/readme.txt", "w") as f:
        f.write("not parquet")
    return files.list_objects(spark, str(root))


def test_backfill_is_idempotent(spark, table, tmp_path):
    listed = bundle_folder(spark, tmp_path / "old")
    assert maintenance.backfill(table, listed, T0) == {"registered": 4, "skipped": 0}
    assert table.read().count() == 60
    assert table.read().where("voids_id IS NOT NULL").count() == 0
    assert maintenance.backfill(table, listed, T0) == {"registered": 0, "skipped": 4}
    assert table.read().count() == 60
    assert reports.layout_audit(table.stored()).where("misplaced_rows > 0").count() == 0


def test_backfill_finishes_a_batch_that_was_stopped(spark, table, tmp_path, monkeypatch):
    listed = bundle_folder(spark, tmp_path / "old")
    write = table.write_batches

    def broken(*_args, **_kwargs):
        raise RuntimeError("no space")

    monkeypatch.setattr(table, "write_batches", broken)
    with pytest.raises(RuntimeError):
        maintenance.backfill(table, listed, T0)
    monkeypatch.setattr(table, "write_batches", write)
    assert maintenance.backfill(table, listed, T0) == {"registered": 0, "skipped": 4}
    assert table.read().count() == 60


def test_backfill_snapshots_are_bounded(spark, table, tmp_path):
    root = tmp_path / "old"
    for i in range(5):
        events(spark, 2, start=10 * i).coalesce(1).write.parquet(str(root / "day" / f"b{i}"))
    # Spark writes each bundle to its own folder; bring them below one prefix.
    flat = root / "flat"
    flat.mkdir()
    for i, (folder, _, names) in enumerate(sorted(os.walk(root / "day"))):
        for name in names:
            if name.endswith(".parquet") and not name.startswith("."):
                os.rename(os.path.join(folder, name), flat / f"batch-{i}.parquet")
    listed = files.list_objects(spark, str(root), "flat/")
    assert maintenance.backfill(table, listed, T0, cap=2) == {"registered": 5, "skipped": 0}
    per_snapshot = table.read().groupBy("snapshot_id").count().orderBy("snapshot_id").collect()
    assert [r["count"] for r in per_snapshot] == [4, 4, 2]
    assert ids(lake.read_changes(table.read(), 1, 1)) == [0, 1, 10, 11]


def test_partial_prefix_registers_only_new_files(spark, tmp_path):
    listed = spark.createDataFrame([(f"d/{i}.parquet",) for i in range(5)] + [("d/x.txt",)], "path string")
    known = listed.where("path < 'd/3'")
    assert files.new_files(listed, known).count() == 2
    assert files.prefix_status(listed, known).collect()[0].asDict() == {"prefix": "d/", "files": 5, "registered": 3, "status": "partial"}


def test_write_options():
    assert lake.write_options("ZSTD")["compression"] == "zstd"
    assert lake.write_options("")["compression"] == lake.write_options("bogus")["compression"] == "snappy"
    assert lake.write_options(parquet_version="2")["parquet.writer.version"] == "v2"
    assert "parquet.writer.version" not in lake.write_options(parquet_version="3'; DROP")
    assert lake.write_options(target_bytes=1000, row_bytes=10)["maxRecordsPerFile"] == "100"


def test_list_objects_hides_dot_files_and_missing_prefix(spark, tmp_path):
    for name in ["raw/type=a/1.bin", "raw/type=b/2.bin", "raw/.tmp/3.bin", "raw/.hidden", "other/4.bin"]:
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"12345")
    listed = files.listing_order(files.list_objects(spark, str(tmp_path), "raw/type="))
    assert [(r.key, r["size"]) for r in listed.collect()] == [("raw/type=a/1.bin", 5), ("raw/type=b/2.bin", 5)]
    assert files.list_objects(spark, str(tmp_path), "nothing/here").count() == 0
    assert files.list_objects(spark, str(tmp_path)).count() == 3


def test_merge_group_limit(spark):
    backlog = spark.createDataFrame([("t", 10, 10 * (8 << 20), 0.0), ("u", 2, 2 << 20, 0.0)], "table_name string, files long, total_bytes long, average_bytes double")
    limit = lambda **k: files.merge_group_limit(backlog, **k).first()[0]
    assert limit(memory_limit="1GB") == 64 and limit(pin=7) == 7 and limit(pin=5000) == 1000
    assert limit(memory_limit="") == limit(memory_limit="80%") == 256
    assert limit(memory_limit="1MB") == 1 and limit(memory_limit="1TB") == 1000
    assert files.merge_group_limit(backlog.limit(0), "1GB").first()[0] == 256
