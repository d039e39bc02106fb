"""Streaming jobs with ``availableNow``: ingest, restart, decode."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark import schemas
from tidemark.functions import identity
from tidemark.operators import payloads
from tidemark.plans.lake import RawEventTable
from tidemark.sources import envelopes
from tidemark.sources.tables import read_event_stream
from tidemark.streaming import jobs

CONTRACT = "0xba5738a18d83d41847dffbdc6101d37c69c9b0cf"
DID = f"did:erc721:137:{CONTRACT}:"
SOURCE = "0xc0dec0dec0dec0dec0dec0dec0dec0dec0dec0de"
T0 = datetime(2026, 6, 1, 12)
ONCE = {"availableNow": True}


def body(i, **over):
    message = {
        "id": str(i),
        "type": fv.TYPE_STATUS,
        "subject": f"{DID}{i % 4}",
        "producer": f"{DID}9",
        "source": SOURCE,
        "time": "2020-01-01T00:00:00Z",
        "data": {"signals": [{"name": "speed", "timestamp": "2020-01-01T00:00:00Z", "value": i}]},
    }
    message.update(over)
    return json.dumps(message)


def drop_file(spark, path, bodies, at=T0):
    rows = [(b, {}, at) for b in bodies]
    spark.createDataFrame(rows, schemas.WIRE_MESSAGES).coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination(180)
    assert query.exception() is None


def ingest(spark, tmp_path, table, **options):
    messages = read_event_stream(spark, str(tmp_path / "in"), 1)
    run(jobs.ingest_query(messages, table, str(tmp_path / "cp"), trigger=ONCE, **options))


def test_ingest_end_to_end_with_restart(spark, tmp_path):
    source = str(tmp_path / "in")
    table = RawEventTable(spark, str(tmp_path / "lake"))
    big = body(50, data={"padding": "x" * 5000})
    drop_file(spark, source, [body(i) for i in range(20)] + [body(3), "{broken", body(99, type="random"), big])
    ingest(spark, tmp_path, table, threshold=4096)
    # Old event times are kept; the copy is dropped; faults are set aside.
    assert table.read().count() == 21
    quarantine = spark.read.parquet(f"{table.root}/quarantine")
    assert sorted(r.reject_reason for r in quarantine.collect()) == ["undecodable", "unsupported_type"]
    stored = table.read().where("data_index_key IS NOT NULL").first()
    assert stored.data is None and jobs.blobs_of(table).where(F.col("data_index_key") == stored.data_index_key).count() == 1
    # Restart from the checkpoint: only the new file is read, copies in the window drop.
    drop_file(spark, source, [body(i) for i in range(18, 25)], T0 + timedelta(seconds=30))
    ingest(spark, tmp_path, table, threshold=4096)
    assert table.read().count() == 26
    assert table.read().groupBy("id").count().where("count > 1").count() == 0


def test_late_files_and_new_checkpoints_lose_nothing(spark, tmp_path):
    table = RawEventTable(spark, str(tmp_path / "lake"))
    source = str(tmp_path / "in")
    for i, minutes in enumerate((0, 1, 2, -30)):  # the last file arrives far behind the others
        drop_file(spark, source, [body(10 * i + j) for j in range(5)], T0 + timedelta(minutes=minutes))
    ingest(spark, tmp_path, table)
    assert table.read().count() == 20
    # A new checkpoint counts its batches from 0 again; its data is new all the same.
    second = str(tmp_path / "in2")
    drop_file(spark, second, [body(100 + j) for j in range(7)])
    run(jobs.ingest_query(read_event_stream(spark, second, 1), table, str(tmp_path / "cp2"), trigger=ONCE))
    assert table.read().count() == 27


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    import shutil

    table = RawEventTable(spark, str(tmp_path / "lake"))
    drop_file(spark, str(tmp_path / "in"), [body(i) for i in range(10)])
    ingest(spark, tmp_path, table)
    # Without its commit the batch runs again when the query restarts.
    shutil.rmtree(tmp_path / "cp" / "commits")
    ingest(spark, tmp_path, table)
    assert table.read().count() == 10


def test_copies_outside_the_window_leave_rehydrated_counts_alone(spark, tmp_path):
    table = RawEventTable(spark, str(tmp_path / "lake"))
    big, other = (body(1, data={"padding": c * 5000}) for c in "xy")
    for i, text in enumerate((big, big, other)):
        drop_file(spark, str(tmp_path / f"in{i}"), [text], T0 + timedelta(minutes=30 * i))
        stream = read_event_stream(spark, str(tmp_path / f"in{i}"), 1)
        run(jobs.ingest_query(stream, table, str(tmp_path / f"cp{i}"), threshold=4096, trigger=ONCE))
    stored = table.read()
    whole = payloads.rehydrate_payloads(stored, jobs.blobs_of(table)).collect()
    assert stored.count() == len(whole) == 3
    assert sorted(bytes(r.payload)[-4:-3] for r in whole) == [b"x", b"x", b"y"]


def test_poison_row_is_isolated(spark, tmp_path):
    table = RawEventTable(spark, str(tmp_path / "lake"))
    drop_file(spark, str(tmp_path / "in"), [body(1), body(2, time="nonsense"), body(3)])
    ingest(spark, tmp_path, table)
    assert sorted(r.id for r in table.read().collect()) == ["1", "3"]


def test_decode_stream_is_replay_safe(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "decoded")
    rows = spark.createDataFrame(
        [(str(i), f"{DID}{i % 3}", json.dumps({"signals": [{"name": "a.b", "timestamp": "2026-06-01T00:00:00Z", "value": i}, {"name": "c", "timestamp": "2026-06-01T00:00:00Z", "value": 1}]})) for i in range(6)],
        "id string, subject string, data string",
    ).withColumns(
        {
            "type": F.lit(fv.TYPE_STATUS),
            "source": F.lit(SOURCE),
            "producer": F.col("subject"),
            "data_version": F.lit("default/v1.0"),
            "time": F.lit(T0),
            "ingest_time": F.lit(T0),
        }
    )
    rows.write.parquet(raw_path)
    for checkpoint in ("cp1", "cp2"):
        stream = spark.readStream.schema(rows.schema).parquet(raw_path)
        run(jobs.decode_query(stream, target, str(tmp_path / checkpoint), 137, CONTRACT, trigger=ONCE))
    decoded = jobs.read_lanes(spark, target)
    assert {r.name_token: r["count"] for r in decoded.groupBy("name_token").count().collect()} == {"a_b": 6, "c": 6}


def test_messages_without_an_id_are_told_apart_by_their_text(spark, tmp_path):
    """Two events of one millisecond that differ in their data only; true copies still drop."""
    bodies = [json.dumps({k: v for k, v in json.loads(body(4, data={"n": i})).items() if k != "id"}) for i in range(3)]
    drop_file(spark, str(tmp_path / "in"), [*bodies, bodies[0], body(7), body(7)])
    table = RawEventTable(spark, str(tmp_path / "lake"))
    ingest(spark, tmp_path, table)
    assert table.read().count() == 4
    assert table.read().select("id").distinct().count() == 4


def test_one_file_of_messages_is_work_for_all_cores(spark, tmp_path):
    drop_file(spark, str(tmp_path / "in"), [body(i) for i in range(100)])
    tasks = []
    rows = read_event_stream(spark, str(tmp_path / "in")).withColumn("task", F.spark_partition_id())
    count = lambda batch, _: tasks.append(batch.select("task").distinct().count())
    run(rows.writeStream.foreachBatch(count).option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    assert tasks[0] == spark.sparkContext.defaultParallelism


def test_arrivals_are_kept_on_disk_and_the_session_keeps_its_settings(spark, tmp_path):
    drop_file(spark, str(tmp_path / "in"), [body(i) for i in range(5)])
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    ingest(spark, tmp_path, RawEventTable(spark, str(tmp_path / "lake")))
    assert spark.conf.get(store) == before
    assert "RocksDBStateStoreProvider" in (tmp_path / "cp" / "offsets" / "0").read_text()


def test_a_trigger_takes_files_up_to_its_bytes(spark, tmp_path):
    for i in range(3):
        drop_file(spark, str(tmp_path / "in"), [body(10 * i + j) for j in range(5)])
    sizes = []
    rows = read_event_stream(spark, str(tmp_path / "in"), max_bytes_per_trigger=1)
    run(rows.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    assert sizes == [5, 5, 5]


def test_one_payload_of_two_callers_is_judged_by_its_caller(spark):
    """A caller without an address is set aside; the same text of another caller is an event,
    and neither is both."""
    header = {"id": "1", "type": fv.TYPE_STATUS, "subject": f"{DID}2", "producer": f"{DID}9", "time": "2020-01-01T00:00:00Z"}
    text = json.dumps({"headers": [header, {**header, "id": "2"}], "data": {"k": 1.5}})
    sent = [(text, {"origin": "payload", "caller": caller}, T0) for caller in (SOURCE, "nobody")]
    rows = jobs.normalized(jobs.parsed(spark.createDataFrame(sent, schemas.WIRE_MESSAGES)))
    got = sorted((r.caller or "", r.id or "", r.reject_reason or "", r.value == text, r.data) for r in rows.collect())
    assert got == [("", "1", "", False, '{"k":1.5}'), ("", "2", "", False, '{"k":1.5}'), ("nobody", "", "invalid_source", True, '{"k":1.5}')]


def test_texts_are_searched_once_for_numbers_and_once_for_an_identifier(spark):
    """Patterns are most of what a message costs."""
    rows = spark.createDataFrame([(body(1), {}, T0)], schemas.WIRE_MESSAGES)

    def used(df, name):
        return df._jdf.queryExecution().analyzed().toString().count(name)

    marked = rows.select(envelopes._marked_numbers(F.col("value")).alias("x"))
    assert used(marked, "regexp_replace") == 1
    did = rows.select(identity.canonical_did(F.col("value"), legacy=False).alias("x"))
    # The digits are looked for and taken; the rest of the identifier is one replacement.
    assert used(did, "regexp_extract") == 2 and used(did, "regexp_replace") == 1
