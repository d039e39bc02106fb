"""Signals: salvage, pruning, coordinate merge against a plain fold, packing."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators import decode

CONTRACT = "0xba5738a18d83d41847dffbdc6101d37c69c9b0cf"
VEHICLE = f"did:erc721:137:{CONTRACT}:7"
T0 = datetime(2026, 6, 1, 12, 0, 0)
LAT, LON, HDOP = fv.SIGNAL_LATITUDE, fv.SIGNAL_LONGITUDE, fv.SIGNAL_HDOP


def raw(spark, *events, subject=VEHICLE, type=fv.TYPE_STATUS):
    """events: lists of (name, millis after T0, value)."""
    rows = []
    for i, signals in enumerate(events):
        elements = [
            {"name": n, "timestamp": (T0 + timedelta(milliseconds=ms)).isoformat(timespec="milliseconds") + "Z", "value": v}
            for n, ms, v in signals
        ]
        rows.append((str(i), subject, type, "src", T0, json.dumps({"signals": elements}), subject, "default/v1.0"))
    schema = "id string, subject string, type string, source string, time timestamp, data string, producer string, data_version string"
    return spark.createDataFrame(rows, schema).withColumn("ingest_time", F.lit(T0 + timedelta(minutes=1)))


def merged(spark, *events):
    pruned = decode.with_pruned(decode.decode_arrays(raw(spark, *events), 137, CONTRACT), F.col("ingest_time"))
    rows = decode.merge_coordinates(pruned).orderBy(F.col("id").cast("int")).collect()
    return [(r.signals, list(r.location_errors)) for r in rows]


def millis(stamp):
    return round((stamp - T0).total_seconds() * 1000)


def plain_fold(signals):
    """The rule written directly: returns locations (ms, lat, lon, hdop) and errors."""
    part, first, out, errors = {}, None, [], []

    def close():
        lat, lon = part.get(LAT), part.get(LON)
        if lat is not None and lon is not None:
            if -90 <= lat <= 90 and -180 <= lon <= 180 and not (lat == 0 and lon == 0):
                out.append((first, lat, lon, part.get(HDOP, 0.0)))
            else:
                errors.append("invalid_coordinate")
        elif lat is not None:
            errors.append("unpaired_latitude")
        elif lon is not None:
            errors.append("unpaired_longitude")
        part.clear()

    for ms, name, value in sorted((ms, n, v) for n, ms, v in signals):
        if name not in (LAT, LON, HDOP):
            continue
        if first is not None and (ms - first >= 500 or name in part):
            close()
            first = None
        part[name] = value
        first = ms if first is None else first
    close()
    return out, errors


def test_full_triple():
    assert plain_fold([(LAT, 0, 1.0), (LON, 100, 2.0), (HDOP, 200, 3.0)]) == ([(0, 1.0, 2.0, 3.0)], [])


def test_coordinate_cases(spark):
    cases = [
        [(LAT, 0, 37.0), (LON, 10, -122.0), (HDOP, 20, 1.5)],
        [(LAT, 0, 0.0), (LON, 0, 0.0)],
        [(HDOP, 0, 1.0)],
        [(LAT, 0, 37.0)],
        [(LON, 0, 37.0), ("speed", 5, 1.0)],
        [(LAT, 0, 1.0), (LON, 499, 2.0)],
        [(LAT, 0, 1.0), (LON, 500, 2.0)],
        [(LAT, 0, 1.0), (LAT, 100, 3.0), (LON, 200, 2.0)],
        [],
    ]
    for (signals, errors), case in zip(merged(spark, *cases), cases):
        want, want_errors = plain_fold(case)
        got = [
            (millis(s.timestamp), s.location.lat, s.location.lon, s.location.hdop) for s in signals if s.name == fv.SIGNAL_LOCATION
        ]
        assert (got, errors) == (want, want_errors), case
        assert not {s.name for s in signals} & {LAT, LON, HDOP}


def test_coordinate_merge_equals_plain_fold(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(400):
        stamps = rng.sample(range(0, 3000, 50), rng.randint(1, 14))
        cases.append(
            [(rng.choice([LAT, LON, HDOP, "speed"]), ms, rng.choice([0.0, 1.5, -45.0, 91.0, 179.0])) for ms in stamps]
        )
    for (signals, errors), case in zip(merged(spark, *cases), cases):
        got = [
            (millis(s.timestamp), s.location.lat, s.location.lon, s.location.hdop) for s in signals if s.name == fv.SIGNAL_LOCATION
        ]
        assert (got, errors) == plain_fold(case)
        assert len([s for s in signals if s.name == "speed"]) == len([c for c in case if c[0] == "speed"])


def test_salvage_keeps_good_elements(spark):
    rows = raw(spark, [("speed", 0, 1.0)])
    body = json.dumps(
        {
            "signals": [
                {"name": "speed", "timestamp": "2026-06-01T12:00:00Z", "value": 3},
                {"name": "speed", "timestamp": "never", "value": 3},
                {"name": "", "timestamp": "2026-06-01T12:00:00Z", "value": 3},
                {"name": "rpm", "timestamp": "2026-06-01T12:00:00Z", "value": "x"},
            ]
        }
    )
    signals, errors = decode.decode_signals(rows.withColumn("data", F.lit(body)), 137, CONTRACT)
    assert [(r.name, r.value) for r in signals.collect()] == [("speed", 3.0)]
    assert sorted(r.reason for r in errors.collect()) == ["bad_timestamp", "bad_value", "missing_name"]


@pytest.mark.parametrize("body", ["", "not json", "[]", '{"signals":5}', '{"other":1}', None])
def test_undecodable_payload_yields_nothing(spark, body):
    rows = raw(spark, [("speed", 0, 1.0)]).withColumn("data", F.lit(body).cast("string"))
    signals, _ = decode.decode_signals(rows, 137, CONTRACT)
    assert signals.count() == 0


def test_foreign_contract_and_other_types_are_not_decoded(spark):
    foreign = raw(spark, [("speed", 0, 1.0)], subject="did:erc721:137:0x" + "0" * 40 + ":7")
    other = raw(spark, [("speed", 0, 1.0)], type=fv.TYPE_SIGNALS)
    for rows in (foreign, other):
        assert decode.decode_signals(rows, 137, CONTRACT)[0].count() == 0


def test_prune_keeps_last_of_equal_pair_and_drops_future(spark):
    events = [[("speed", 10, 1.0), ("rpm", 10, 5.0), ("speed", 10, 2.0), ("speed", 20, 3.0), ("speed", 10 * 60_000, 9.0)]]
    ((signals, _),) = merged(spark, *events)
    assert [(s.name, millis(s.timestamp), s.value) for s in signals] == [("rpm", 10, 5.0), ("speed", 10, 2.0), ("speed", 20, 3.0)]


def test_pack_and_unpack_are_inverse(spark):
    events = [[("a", 5, 1.0), ("b", 1, 2.0), ("a", 2, 3.0)], [("a", 1, 4.0)]]
    packed = decode.decode_packed(raw(spark, *events), 137, CONTRACT, F.col("ingest_time"))
    rows = packed.orderBy("event_key", "name").collect()
    assert [(r.name, [s.value for s in r.signals]) for r in rows] == [("a", [3.0, 1.0]), ("b", [2.0]), ("a", [4.0])]
    assert len({r.dedup_id for r in rows}) == 3 and all(len(r.dedup_id) == 32 for r in rows)
    assert rows[0].header.type == fv.TYPE_SIGNALS
    back = decode.unpack(packed).select("event_key", "name", "timestamp", "value")
    assert back.count() == 4


def test_plain_decode_plan_has_no_exchange(spark):
    packed = decode.decode_packed(raw(spark, [("a", 5, 1.0)]), 137, CONTRACT, F.col("ingest_time"))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # The parse must appear once: a pushed-down copy would evaluate it per element.
    assert packed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_registered_decoder_takes_its_source(spark):
    def doubled(rows):
        out = decode.decode_default(rows)
        twice = F.transform("signals", lambda s: s.withField("value", s["value"] * 2))
        return out.withColumn("signals", twice)

    decode.register_decoder("src", doubled)
    try:
        signals, _ = decode.decode_signals(raw(spark, [("a", 0, 4.0)]), 137, CONTRACT)
        assert [r.value for r in signals.collect()] == [8.0]
    finally:
        decode.unregister_decoder("src")


def test_latest_signals(spark):
    signals, _ = decode.decode_signals(raw(spark, [("a", 0, 1.0), ("a", 9, 2.0), ("b", 3, 5.0)]), 137, CONTRACT)
    got = decode.latest_signals(signals.drop("event_key")).orderBy("name").collect()
    assert [(r.name, r.value) for r in got] == [("a", 2.0), ("b", 5.0)]
