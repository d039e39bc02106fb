"""Envelopes, header rules, fan-out, attestations, payload split and sealing."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import sealing
from tidemark.operators import attest, normalize, payloads
from tidemark.sources.envelopes import parse_envelopes, split_rejects

ADDRESS = "0xbA5738a18d83D41847dfFbDC6101d37C69c9B0cF"
DID = f"did:erc721:137:{ADDRESS}:"
SOURCE = "0xc0dec0dec0dec0dec0dec0dec0dec0dec0dec0de"
NOW = datetime(2026, 6, 1, 12, 0, 0)


def messages(spark, bodies, headers=None):
    rows = [(i, b, (headers or {}).get(i, {}), NOW) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "i int, value string, headers map<string,string>, ingest_time timestamp")


def test_malformed_messages_are_rejected_never_fatal(spark):
    sound = json.dumps({"id": "m-1", "time": "2025-03-04T05:06:07.5+02:00", "tags": [], "data": [0, {"deep": {"er": {}}}]})
    bodies = [sound, " " + sound + "\n", '{"data":null}', *(sound[:cut] for cut in range(1, len(sound), 9))]
    good = len(bodies) - len(range(1, len(sound), 9))
    wrong = {"time": ["05:06", "2025-03-04", "2025-03-04 05:06:07Z", "2025-13-04T05:06:07Z"], "tags": ["t", {"t": 1}, 4]}
    bodies += [json.dumps({**json.loads(sound), name: value}) for name, values in wrong.items() for value in values]
    bodies += ["7", "true", '"text"', "[]", " ", "\x00", None]
    got = parse_envelopes(messages(spark, bodies)).orderBy("i").collect()
    assert [r.reject_reason is None for r in got] == [True] * good + [False] * (len(bodies) - good)
    accepted, rejected = split_rejects(parse_envelopes(messages(spark, bodies)))
    assert accepted.count() + rejected.count() == len(bodies)


def test_numbers_keep_their_text(spark):
    bodies = [
        '{"id":"x","data":{"a":1e5,"b":0.12345678901234567890123,"c":[-2.50, 3],"s":"n: 1, 2 \\" 5"}}',
        '{"id":7,"data":12345678901234567890123456789}',
        '{"data":{"a":01}}',
        '{"data":{"a":"\ufdd01.0\ufdd0","b":1.5}}',
    ]
    a, b, c, d = parse_envelopes(messages(spark, bodies)).orderBy("i").collect()
    assert a.data == '{"a":1e5,"b":0.12345678901234567890123,"c":[-2.50,3],"s":"n: 1, 2 \\" 5"}'
    assert (b.id, b.data) == ("7", "12345678901234567890123456789")
    assert c.reject_reason == "undecodable"
    assert d.reject_reason is None and "1.5" in d.data


def test_missing_ids_differ_by_message(spark):
    bodies = [_event(id="", data={"n": i}) for i in range(3)] + [_event(id=None, data={"n": 9}), _event(id="", data={"n": 0})]
    rows = normalize.validate_connection(parse_envelopes(messages(spark, bodies))).orderBy("i").collect()
    assert all(r.reject_reason is None and len(r.id) == 27 for r in rows)
    ids = [r.id for r in rows]
    assert len(set(ids)) == 4 and ids[0] == ids[4]


def test_storage_headers_and_extras(spark):
    bodies = ['{"id":"x","junk":{"b":[1]},"n":5,"data":"just a string"}', '{"id":"y","data":{"k":"v"},"tags":["a"]}']
    headers = {0: {fv.HEADER_VOIDS_ID: "v1", fv.HEADER_DATA_INDEX_KEY: "k1"}}
    a, b = parse_envelopes(messages(spark, bodies, headers)).orderBy("i").collect()
    assert (a.voids_id, a.data_index_key) == ("v1", "k1")
    assert json.loads(a.extras) == {"junk": {"b": [1]}, "n": 5}
    assert a.data == '"just a string"' and json.loads(b.data) == {"k": "v"}
    assert b.extras == "{}" and b.tags == ["a"]


def _event(**over):
    body = {
        "id": "33",
        "type": fv.TYPE_STATUS,
        "subject": DID + "2",
        "producer": DID + "1",
        "source": SOURCE,
        "time": "2026-06-01T11:00:00Z",
        "data": {"k": "v"},
    }
    body.update(over)
    return json.dumps({k: v for k, v in body.items() if v is not None})


def _reasons(spark, bodies):
    checked = normalize.validate_connection(parse_envelopes(messages(spark, bodies)))
    return [r.reject_reason for r in checked.orderBy("i").collect()]


def test_connection_rules(spark):
    cases = [
        (_event(), None),
        (_event(subject=DID.replace("erc721", "nft").replace(ADDRESS + ":", ADDRESS + "_") + "2"), None),
        (_event(time="2036-01-01T00:00:00Z"), None),
        (_event(type="random"), "unsupported_type"),
        (_event(id="a$"), "invalid_id"),
        (_event(tags=["x" * 8193]), "header_too_large"),
        (_event(tags=["y" * 16] * 1000), "header_too_large"),
        (_event(tags=["z" * 7000]), None),
        (_event(junk="j" * 8193), "header_too_large"),
        (_event(producer="not-a-did"), "invalid_producer"),
        (_event(subject="../../../tenantB/x"), "invalid_subject"),
        (_event(source="../etc"), "invalid_source"),
        (_event(datacontenttype="image/png"), "content_type_not_json"),
    ]
    assert _reasons(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_defaults_and_canonical_form(spark):
    body = _event(id="", subject="", time=None, producer=(DID + "1").lower())
    row = normalize.validate_connection(parse_envelopes(messages(spark, [body]))).first()
    assert row.subject == row.producer == DID + "1"
    assert row.time == NOW and row.specversion == "1.0" and row.datacontenttype == "application/json"
    assert row.source == "0x" + row.source[2:] and row.source.lower() == SOURCE
    assert len(row.id) == 27


def _payload(spark, headers, data="", body='{"b":1}'):
    names = normalize.HEADER_NAMES
    full = [tuple(h.get(n) for n in names) for h in headers]
    schema = f"payload_id string, source string, headers array<{normalize.HEADER}>, data string, body string, ingest_time timestamp"
    return spark.createDataFrame([("p1", SOURCE, full, data, body, NOW)], schema)


def test_fan_out_shares_payload_and_default_id(spark):
    header = {"type": fv.TYPE_STATUS, "subject": DID + "2", "producer": DID + "1", "time": NOW}
    events, rejected = normalize.fan_out(_payload(spark, [header, {**header, "type": fv.TYPE_FINGERPRINT}]))
    rows = events.orderBy("header_index").collect()
    assert [r.type for r in rows] == [fv.TYPE_STATUS, fv.TYPE_FINGERPRINT]
    assert rows[0].id == rows[1].id and {r.data for r in rows} == {'{"b":1}'}
    assert rejected.count() == 0


def test_one_bad_header_rejects_the_payload(spark):
    header = {"type": fv.TYPE_STATUS, "subject": DID + "2", "producer": DID + "1", "time": NOW}
    events, rejected = normalize.fan_out(_payload(spark, [header, {**header, "type": "x"}]))
    assert events.count() == 0 and [r.reject_reason for r in rejected.collect()] == ["unsupported_type"]
    events, rejected = normalize.fan_out(_payload(spark, []))
    assert events.count() == 0 and [r.reject_reason for r in rejected.collect()] == ["no_headers"]


def test_raw_row_rules(spark):
    rows = spark.createDataFrame(
        [
            ("a", datetime(2026, 6, 1, 0, 0, 0, 123456), '{"v":1}', None, ""),
            ("b", datetime(2026, 6, 1), None, "SGVsbG8gV29ybGQ=", ""),
            ("c", datetime(2026, 6, 1), "", None, "cloudevent/blobs/xyz"),
        ],
        "id string, time timestamp, data string, data_base64 string, data_index_key string",
    )
    fixed = {n: F.lit("x") for n in ("subject", "type", "source", "producer", "datacontenttype", "dataversion")}
    rows = rows.withColumns(
        {**fixed, "tags": F.array().cast("array<string>"), "dataschema": F.lit(""), "signature": F.lit(None).cast("string"), "extras": F.lit("{}"), "voids_id": F.lit("")}
    )
    a, b, c = normalize.to_raw_row(rows).orderBy("id").collect()
    assert a.time.microsecond == 123000 and a.data == '{"v":1}' and a.data_base64 is None
    assert b.data is None and bytes(b.data_base64) == b"SGVsbG8gV29ybGQ="
    assert c.data is None and c.data_base64 is None and c.data_index_key == "cloudevent/blobs/xyz"
    assert {r.extras for r in (a, b, c)} == {"{}"} and {r.voids_id for r in (a, b, c)} == {None}


def test_fingerprint_gate(spark):
    rows = spark.createDataFrame(
        [
            (1, fv.TYPE_FINGERPRINT, '{"vin":"1HGCM82633A123456"}', None),
            (2, fv.TYPE_FINGERPRINT, '{"vin":"1HGCM123"}', "dropped_vin"),
            (3, fv.TYPE_STATUS, '{"vin":"1HGCM123"}', None),
            (4, fv.TYPE_FINGERPRINT, '{"this is not valid JSON', "invalid_payload"),
        ],
        "i int, type string, data string, want string",
    )
    got = rows.orderBy("i").select("want", normalize.fingerprint_gate().alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


ATTEST = "type string, subject string, source string, id string, producer string, time timestamp, datacontenttype string, data string, data_base64 string, signature_valid boolean"


def _attest(spark, *rows):
    base = dict(type=fv.TYPE_ATTESTATION, subject=DID.lower() + "1005", source=ADDRESS.lower(), id="u1", producer=ADDRESS, time=NOW, datacontenttype=None, data="{}", data_base64=None, signature_valid=True)
    filled = [tuple({**base, **r}.values()) for r in rows]
    df = spark.createDataFrame(filled, ATTEST)
    empty = F.lit(None).cast("string")
    df = df.withColumns(
        {n: empty for n in ("specversion", "dataschema", "dataversion", "signature")}
        | {"extras": F.lit("{}"), "tags": F.lit(None).cast("array<string>"), "caller": F.lit(SOURCE), "ingest_time": F.lit(NOW)}
    )
    return attest.normalize_attestations(df).collect()


def test_attestations(spark):
    (row,) = _attest(spark, {})
    assert row.reject_reason is None and row.subject == DID + "1005" and row.source == ADDRESS
    (row,) = _attest(spark, {"subject": "did:ethr:1:" + ADDRESS.lower(), "source": "", "type": ""})
    assert row.subject == "did:ethr:1:" + ADDRESS and row.source.lower() == SOURCE and row.type == fv.TYPE_ATTESTATION
    cases = [
        ({"source": "not-an-address"}, "invalid_source"),
        ({"type": fv.TYPE_SIGNALS}, "unsupported_type"),
        ({"time": datetime(2026, 6, 1, 13)}, "future_time"),
        ({"subject": "x"}, "invalid_subject"),
        ({"signature_valid": False}, "invalid_signature"),
        ({"datacontenttype": "image/png"}, "content_type_not_json"),
        ({"data_base64": "aGVsbG8=", "data": None, "datacontenttype": "image/png"}, None),
        ({"data_base64": "aGVsbG8=", "data": None}, "missing_content_type"),
    ]
    for change, want in cases:
        assert _attest(spark, change)[0].reject_reason == want, change


def test_tombstones(spark):
    limit = fv.MAX_REASON_BYTES

    def told(voids, reason=None):
        return json.dumps({"voidsId": voids} | ({} if reason is None else {"reason": reason}))

    cases = [(told(v), v, None) for v in ("9", "event_4-b", "A" * 40)]
    cases += [(told("9", r), "9", None) for r in ("", "é" * (limit // 2), None)]
    cases += [(told("9", "é" * (limit // 2) + "x"), None, "tombstone_reason_too_long")]
    cases += [(told(v), None, "tombstone_invalid_voids_id") for v in ("a$b", "tab\tin", "#")]
    cases += [(told(v), None, "tombstone_voids_id_required") for v in ("", None)]
    cases += [(text, None, "tombstone_voids_id_required") for text in ('{"voidsID":"9"}', "{}")]
    cases += [(text, None, "tombstone_not_an_object") for text in ("[]", "9", '["voidsId"]', '{"voidsId":9}', '{"voidsId":"9","reason":[]}')]
    cases += [(None, None, "tombstone_data_required"), (" ", None, "tombstone_not_an_object")]
    for data, voids, fault in cases:
        row = _attest(spark, {"type": fv.TYPE_TOMBSTONE, "data": data})[0]
        assert (row.voids_id, row.reject_reason) == (voids, fault), data


def _payload_rows(spark, rows):
    df = spark.createDataFrame(rows, "id string, data string, data_base64 string")
    return df.withColumns(
        {
            "subject": F.lit(DID + "1"),
            "type": F.lit(fv.TYPE_ATTESTATION),
            "source": F.lit(SOURCE),
            "time": F.lit(NOW),
            "ingest_time": F.lit(NOW),
            "data_index_key": F.lit(None).cast("string"),
        }
    )


def test_split_threshold_and_faults(spark):
    import base64

    big = base64.b64encode(b"z" * 4096).decode()
    rows = _payload_rows(
        spark, [("at", "x" * 64, None), ("over", "x" * 65, None), ("b64", None, big), ("bad", None, "!" * 400)]
    )
    stored, blobs, faults = payloads.split_payloads(rows, 64)
    kept = {r.id: r for r in stored.collect()}
    assert set(kept) == {"at", "over", "b64"} and [r.id for r in faults.collect()] == ["bad"]
    assert kept["at"].data == "x" * 64 and kept["at"].data_index_key is None
    assert kept["over"].data is None and kept["over"].data_index_key.startswith(f"{fv.BLOB_PREFIX}{DID}1/2026/06/01/")
    by_key = {r.data_index_key: bytes(r.payload) for r in blobs.collect()}
    assert by_key[kept["b64"].data_index_key] == b"z" * 4096
    back = payloads.rehydrate_payloads(stored.withColumn("data_base64", F.encode("data_base64", "UTF-8")), blobs)
    assert {r.id: bytes(r.payload) for r in back.collect()} == {"at": b"x" * 64, "over": b"x" * 65, "b64": b"z" * 4096}


KEY = "KioqKioqKioqKioqKioqKioqKioqKioqKioqKioqKio="


def test_sealed_golden_vector(spark):
    sealed = "REJFMfpbx2YHkkRYAdtRPzuxzz7dwfQJNizKGPt2rTfyuQxLDF656mDN5H8zlpCmikO3wJcKpg=="
    row = spark.range(1).select(
        sealing.open_sealed(F.unbase64(F.lit(sealed)), KEY, F.lit("cloudevent/blobs/golden")).alias("p")
    )
    opened = bytes(row.first().p)
    assert len(opened) == 23 and opened.endswith(b" blob format v1")


def test_sealing_failures(spark):
    other = "MDEyMzQ1Njc4OWFiY2RlZjAxMjM0NTY3ODlhYmNkZWY="
    rows = spark.sql("SELECT CAST('hello' AS BINARY) AS p").withColumn("blob", sealing.seal(F.col("p"), KEY, F.lit("k")))
    rows = rows.persist()
    got = rows.select(
        sealing.open_sealed(F.col("blob"), KEY, F.lit("k")).alias("good"),
        sealing.open_sealed(F.col("blob"), other, F.lit("k")).alias("wrong_key"),
        sealing.open_sealed(F.col("blob"), KEY, F.lit("other")).alias("wrong_path"),
        sealing.open_sealed(F.concat("blob", F.lit(b"x")), KEY, F.lit("k")).alias("tampered"),
        sealing.open_sealed(F.lit(b"DBE1short"), KEY, F.lit("k")).alias("short"),
        sealing.open_sealed(F.col("p"), KEY, F.lit("k")).alias("plain"),
    ).first()
    rows.unpersist()
    assert bytes(got.good) == b"hello" and bytes(got.plain) == b"hello"
    assert got.wrong_key is None and got.wrong_path is None and got.tampered is None and got.short is None
