"""Queries over messages and raw events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.catalog.common import (
    CHAIN,
    CONTRACT,
    DID,
    KEY_SQL,
    RAW,
    RAW_DUP,
    ROWS_OF_A_TASK,
    SOURCE,
    adapt,
    as_of,
    load,
    millis,
    oracle,
    raw_events,
    raw_events_dup,
)
from tidemark.functions import checks, identity, sealing, text
from tidemark.operators import attest, dedup, normalize, ordered, payloads, reports
from tidemark.operators.throttle import throttle_first
from tidemark.plans.lake import date_predicate, union_native_and_backfilled, with_partition_columns
from tidemark.sources.envelopes import parse_envelopes
from tidemark.session import scratch_path, spread
from tidemark.sources.tables import sample_events

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


R = f"raw AS ({oracle(RAW)})"
RD = f"raw AS ({oracle(RAW_DUP)})"

# ---- envelopes --------------------------------------------------------------

MESSAGES = f"""
SELECT event_id, ts AS ingest_time,
       CASE WHEN event_id % 97 = 0 THEN '{{"data":'
            WHEN event_id % 89 = 0 THEN '[1,2,3]'
            WHEN event_id % 83 = 0 THEN '{{"id":"x","time":"not-a-time"}}'
            WHEN event_id % 79 = 0 THEN 'null'
            ELSE concat('{{"id":"', CAST(event_id AS STRING), '","subject":"{DID}', CAST(user_id AS STRING),
                        '","type":"{fv.TYPE_STATUS}","time":"', ISO(ts), '","data":', props,
                        CASE WHEN event_id % 5 = 0 THEN concat(',"custom":', CAST(event_id % 10 AS STRING)) ELSE '' END,
                        '}}') END AS value,
       CASE WHEN event_id % 11 = 0 THEN CAST(event_id - 1 AS STRING) END AS voids_header
FROM {{events}}
"""


@query(
    "parse_envelopes",
    f"""
WITH m AS ({oracle(MESSAGES)}),
p AS (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) ELSE 'BROKEN' END AS kind FROM m),
q AS (SELECT *, CASE WHEN kind <> 'OBJECT' THEN 'undecodable'
                     WHEN try_cast(value->>'$.time' AS TIMESTAMP) IS NULL THEN 'undecodable' ELSE '' END AS reason FROM p)
SELECT event_id, reason AS reject_reason,
       CASE WHEN kind = 'OBJECT' THEN coalesce(value->>'$.id', '') ELSE '' END AS id,
       CASE WHEN kind = 'OBJECT' THEN coalesce(value->>'$.subject', '') ELSE '' END AS subject,
       CASE WHEN reason = '' THEN epoch_ms(date_trunc('millisecond', CAST(value->>'$.time' AS TIMESTAMP))) ELSE -1 END AS time_ms,
       CASE WHEN kind = 'OBJECT' THEN coalesce(CAST(value->'$.data' AS VARCHAR), '') ELSE '' END AS data,
       CASE WHEN kind <> 'OBJECT' THEN '' WHEN json_extract(value, '$.custom') IS NOT NULL
            THEN concat('{{"custom":', value->>'$.custom', '}}') ELSE '{{}}' END AS extras,
       coalesce(voids_header, '') AS voids_id
FROM q""",
)
def parse_envelopes_query(spark, d):
    messages = adapt(spark, d, MESSAGES, ("ingest_time",), heavy=True)
    headers = F.create_map(F.lit(fv.HEADER_VOIDS_ID), F.col("voids_header"))
    parsed = parse_envelopes(messages.withColumn("headers", headers))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    is_object = F.col("extras").isNotNull() & (F.from_json("value", "map<string,string>").isNotNull())
    return parsed.select(
        "event_id",
        blank("reject_reason"),
        blank("id"),
        blank("subject"),
        F.coalesce(F.unix_millis("time"), F.lit(-1)).alias("time_ms"),
        blank("data"),
        F.when(is_object, F.col("extras")).otherwise("").alias("extras"),
        blank("voids_id"),
    )


# ---- header validation ------------------------------------------------------

LEGACY = f"did:nft:{CHAIN}:{CONTRACT}_"

HEADERS = f"""
SELECT event_id, ts AS ingest_time,
       CASE WHEN event_id % 29 = 0 THEN 'bad$' WHEN event_id % 3 = 0 THEN '1.0' END AS specversion,
       CASE WHEN event_id % 31 = 0 THEN 'other.type' ELSE '{fv.TYPE_STATUS}' END AS type,
       CASE WHEN event_id % 37 = 0 THEN 'bad subject$' WHEN event_id % 41 = 0 THEN concat('{LEGACY}', CAST(user_id AS STRING))
            WHEN event_id % 43 = 0 THEN '../../x' WHEN event_id % 53 = 0 THEN ''
            ELSE concat('{DID}', CAST(user_id AS STRING)) END AS subject,
       CASE WHEN event_id % 59 = 0 THEN 'not-an-address' ELSE '{SOURCE}' END AS source,
       CASE WHEN event_id % 47 = 0 THEN '' ELSE concat('{DID}', CAST(user_id + 1000 AS STRING)) END AS producer,
       CASE WHEN event_id % 61 = 0 THEN 'a$b' ELSE CAST(event_id AS STRING) END AS id,
       CASE WHEN event_id % 79 = 0 THEN ts + INTERVAL '1' DAY WHEN event_id % 73 <> 0 THEN ts END AS time,
       CASE WHEN event_id % 71 = 0 THEN 'image/png' END AS datacontenttype,
       CASE WHEN event_id % 67 = 0 THEN 'schema?' END AS dataschema,
       'default/v1.0' AS dataversion
FROM {{events}}
"""

_FAULT_SQL = f"""
h AS ({oracle(HEADERS)}),
filled AS (
  SELECT event_id, ingest_time, coalesce(specversion, '1.0') AS specversion, type,
         CASE WHEN subject = '' THEN producer ELSE subject END AS subject, source, producer, id,
         coalesce(time, ingest_time) AS time, coalesce(datacontenttype, 'application/json') AS datacontenttype, dataschema
  FROM h),
judged AS (
  SELECT *, CASE
    WHEN datacontenttype <> 'application/json' THEN 'content_type_not_json'
    WHEN NOT regexp_full_match(id, '[a-zA-Z0-9_/,. :-]+') THEN 'invalid_id'
    WHEN NOT regexp_full_match(specversion, '[a-zA-Z0-9_/,. :-]+') THEN 'invalid_specversion'
    WHEN dataschema IS NOT NULL THEN 'invalid_dataschema'
    WHEN subject <> '' AND NOT regexp_full_match(subject, '[a-zA-Z0-9_/,. :-]+') THEN 'invalid_subject'
    WHEN type = 'other.type' THEN 'unsupported_type'
    WHEN NOT regexp_full_match(subject, 'did:(erc721:[0-9]+:0x[0-9a-f]{{40}}:|nft:[0-9]+:0x[0-9a-f]{{40}}_)[0-9]+') THEN 'invalid_subject'
    WHEN NOT regexp_full_match(producer, 'did:erc721:[0-9]+:0x[0-9a-f]{{40}}:[0-9]+') THEN 'invalid_producer'
    WHEN NOT regexp_full_match(source, '0x[0-9a-f]{{40}}') THEN 'invalid_source'
    ELSE '' END AS reject_reason
  FROM filled)"""


def _headers(spark, d):
    rows = adapt(spark, d, HEADERS, ("ingest_time", "time"), heavy=True)
    return rows.withColumns(
        {
            "tags": F.lit(None).cast("array<string>"),
            "signature": F.lit(None).cast("string"),
            "extras": F.lit("{}"),
        }
    )


@query(
    "validate_headers",
    f"""WITH {_FAULT_SQL}
SELECT event_id, reject_reason, specversion, datacontenttype, id,
       CASE WHEN reject_reason = '' THEN replace(replace(subject, 'did:nft:', 'did:erc721:'), '{CONTRACT}_', '{CONTRACT}:')
            ELSE lower(subject) END AS subject,
       source, producer, epoch_ms(date_trunc('millisecond', time)) AS time_ms,
       time > ingest_time + INTERVAL '300' SECOND AS is_future
FROM judged""",
)
def validate_headers(spark, d):
    checked = normalize.validate_connection(_headers(spark, d))
    return checked.select(
        "event_id",
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
        "specversion",
        "datacontenttype",
        "id",
        F.lower("subject").alias("subject"),
        F.lower("source").alias("source"),
        F.lower("producer").alias("producer"),
        millis("time"),
        "is_future",
    )


@query(
    "ingest_report",
    f"""WITH {_FAULT_SQL}
SELECT source, CASE WHEN reject_reason = '' THEN 'accepted' ELSE reject_reason END AS outcome, count(*) AS events
FROM judged GROUP BY ALL""",
)
def ingest_report(spark, d):
    checked = normalize.validate_connection(_headers(spark, d), canonical=False)
    return reports.ingest_report(checked)


@query(
    "quarantine_classes",
    f"""WITH {_FAULT_SQL}
SELECT 'invalid' AS reject_class, reject_reason, count(*) AS events FROM judged WHERE reject_reason <> '' GROUP BY ALL""",
)
def quarantine_classes(spark, d):
    checked = normalize.validate_connection(_headers(spark, d), canonical=False)
    rejected = checked.where("reject_reason IS NOT NULL")
    return rejected.groupBy(reports.reject_class().alias("reject_class"), "reject_reason").agg(
        F.count("*").alias("events")
    )


# ---- fan-out ----------------------------------------------------------------

_FAN_SQL = f"""
heads AS (
  SELECT event_id AS payload_id, CAST(i AS INTEGER) AS header_index, ts, props,
         CASE WHEN i = 0 THEN substring(sha256(CAST(event_id AS VARCHAR)), 1, 27) ELSE concat(event_id, '-', i) END AS id,
         CASE WHEN (event_id + i) % 17 = 0 THEN 'other.type' ELSE '{fv.TYPE_STATUS}' END AS type,
         CASE WHEN (event_id + i) % 23 = 0 THEN 'nobody' ELSE concat('{DID}', user_id) END AS subject
  FROM events, range(event_id % 4) r(i)),
judged AS (
  SELECT *, CASE WHEN type = 'other.type' THEN 'unsupported_type' WHEN subject = 'nobody' THEN 'invalid_subject' END AS fault
  FROM heads),
faults AS (SELECT payload_id, arg_min(fault, header_index) AS fault FROM judged WHERE fault IS NOT NULL GROUP BY 1)"""


def _payloads(spark, d):
    e = spread(load(spark, d, "events"), ROWS_OF_A_TASK).withColumn("ts", F.col("ts").cast("timestamp"))
    eid = F.col("event_id")

    def header(i):
        values = {
            "type": F.when((eid + i) % 17 == 0, F.lit("other.type")).otherwise(F.lit(fv.TYPE_STATUS)),
            "subject": F.when((eid + i) % 23 == 0, F.lit("nobody")).otherwise(F.concat(F.lit(DID), F.col("user_id").cast("string"))),
            "producer": F.concat(F.lit(DID), (F.col("user_id") + 1000).cast("string")),
            "id": F.when(i > 0, F.concat_ws("-", eid.cast("string"), i.cast("string"))).otherwise(""),
            "time": F.col("ts"),
        }
        fields = []
        for part in normalize.HEADER_NAMES:
            kind = {"time": "timestamp", "tags": "array<string>"}.get(part, "string")
            fields.append(values.get(part, F.lit(None)).cast(kind).alias(part))
        return F.struct(*fields)

    every = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: i)
    wanted = F.filter(every, lambda i: i < eid % 4)
    return e.select(
        eid.alias("payload_id"),
        F.lit(SOURCE).alias("source"),
        F.transform(wanted, header).alias("headers"),
        F.when(eid % 2 == 0, F.col("props")).otherwise("").alias("data"),
        F.concat(F.lit('{"body":'), eid.cast("string"), F.lit("}")).alias("body"),
        F.col("ts").alias("ingest_time"),
    )


@query(
    "fan_out",
    f"""WITH {_FAN_SQL}
SELECT payload_id, header_index, id, subject,
       CASE WHEN payload_id % 2 = 0 THEN props ELSE concat('{{"body":', payload_id, '}}') END AS data
FROM judged WHERE payload_id NOT IN (SELECT payload_id FROM faults)""",
)
def fan_out(spark, d):
    events, _ = normalize.fan_out(_payloads(spark, d))
    return events.select("payload_id", "header_index", "id", F.lower("subject").alias("subject"), "data")


@query(
    "fan_out_rejects",
    f"""WITH {_FAN_SQL}
SELECT e.event_id AS payload_id, CASE WHEN e.event_id % 4 = 0 THEN 'no_headers' ELSE f.fault END AS reject_reason
FROM events e LEFT JOIN faults f ON f.payload_id = e.event_id WHERE e.event_id % 4 = 0 OR f.fault IS NOT NULL""",
)
def fan_out_rejects(spark, d):
    _, rejected = normalize.fan_out(_payloads(spark, d))
    return rejected.select("payload_id", "reject_reason")


_TURNS = """
SELECT conv_id, turn, role, CASE WHEN length(text) % 7 = 0 THEN 'even_sevens' WHEN length(text) % 11 = 0 THEN 'elevens' END AS reason
FROM {conversations}
"""


@query(
    "payload_level_rejection",
    f"""WITH t AS ({oracle(_TURNS)}),
f AS (SELECT conv_id, arg_min(reason, turn) AS fault FROM t WHERE reason IS NOT NULL GROUP BY 1)
SELECT t.conv_id, t.turn, coalesce(f.fault, '') AS reason FROM t LEFT JOIN f USING (conv_id)""",
)
def payload_level_rejection(spark, d):
    rows = adapt(spark, d, _TURNS)
    judged = normalize.reject_whole_payload(rows, "conv_id", "turn", "reason")
    return judged.select("conv_id", "turn", F.coalesce("reason", F.lit("")).alias("reason"))


# ---- event-level gates ------------------------------------------------------

FINGERPRINTS = f"""
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '{fv.TYPE_STATUS}' ELSE '{fv.TYPE_FINGERPRINT}' END AS type,
       CASE event_id % 7 WHEN 0 THEN '{{"this is not' WHEN 1 THEN '{{"vin":"1HGCM82633A123456"}}' WHEN 2 THEN '{{"vin":"1HGCM123"}}'
            WHEN 3 THEN '{{"vin":"1HGCM82633A12345I"}}' WHEN 4 THEN '{{"vin":"SNT33-042261"}}'
            WHEN 5 THEN concat('{{"vin":"', CAST(10000000000000000 + event_id AS STRING), '"}}') ELSE props END AS data
FROM {{events}}
"""


@query(
    "fingerprint_gate",
    f"""WITH f AS ({oracle(FINGERPRINTS)})
SELECT event_id, CASE WHEN type <> '{fv.TYPE_FINGERPRINT}' THEN 'kept' WHEN NOT json_valid(data) THEN 'invalid_payload'
     WHEN regexp_full_match(coalesce(data->>'$.vin', ''), '[A-HJ-NPR-Z0-9]{{17}}|[A-Z0-9]{{2,6}}-[0-9]{{4,7}}') THEN 'kept'
     ELSE 'dropped_vin' END AS outcome FROM f""",
)
def fingerprint_gate(spark, d):
    rows = adapt(spark, d, FINGERPRINTS, heavy=True)
    return rows.select("event_id", F.coalesce(normalize.fingerprint_gate(), F.lit("kept")).alias("outcome"))


TOMBSTONES = """
SELECT event_id,
       CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '"just a string"' WHEN 2 THEN '{"reason":"oops"}'
            WHEN 3 THEN '{"voidsId":"","reason":"oops"}' WHEN 4 THEN '{"voidsId":"bad id$"}'
            WHEN 5 THEN concat('{"voidsId":"t-', CAST(event_id AS STRING), '","reason":"', repeat('a', CAST(505 + event_id % 16 AS INTEGER)), '"}')
            WHEN 6 THEN '{"voidsId":7}' WHEN 7 THEN '{"voidsId"'
            ELSE concat('{"voidsId":"target-', CAST(user_id AS STRING), '"}') END AS data
FROM {events}
"""


@query(
    "parse_tombstone",
    f"""WITH t AS ({oracle(TOMBSTONES)}),
p AS (SELECT *, json_valid(data) AS ok FROM t),
j AS (SELECT *, CASE WHEN data = '' THEN 'tombstone_data_required' WHEN NOT ok THEN 'tombstone_not_an_object'
   WHEN json_type(data) <> 'OBJECT' THEN 'tombstone_not_an_object'
   WHEN coalesce(json_type(data, '$.voidsId'), 'VARCHAR') <> 'VARCHAR' THEN 'tombstone_not_an_object'
   WHEN coalesce(data->>'$.voidsId', '') = '' THEN 'tombstone_voids_id_required'
   WHEN NOT regexp_full_match(data->>'$.voidsId', '[a-zA-Z0-9_/,. :-]+') THEN 'tombstone_invalid_voids_id'
   WHEN strlen(coalesce(data->>'$.reason', '')) > 512 THEN 'tombstone_reason_too_long' ELSE '' END AS fault FROM p)
SELECT event_id, fault, CASE WHEN fault = '' THEN data->>'$.voidsId' ELSE '' END AS voids_id FROM j""",
)
def parse_tombstone(spark, d):
    rows = adapt(spark, d, TOMBSTONES, heavy=True)
    voids_id, fault = attest.parse_tombstone(F.col("data"))
    blank = F.lit("")
    return rows.select(
        "event_id", F.coalesce(fault, blank).alias("fault"), F.coalesce(voids_id, blank).alias("voids_id")
    )


ATTESTATIONS = f"""
SELECT event_id, ts AS ingest_time, '{SOURCE}' AS caller,
       CASE WHEN event_id % 13 = 0 THEN 'not-an-address' WHEN event_id % 3 = 0 THEN '{CONTRACT}' ELSE '' END AS source,
       CASE WHEN event_id % 17 = 0 THEN 'no-did' WHEN event_id % 4 = 0 THEN 'did:ethr:1:{CONTRACT}'
            ELSE concat('{DID}', CAST(user_id AS STRING)) END AS subject,
       CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '{fv.TYPE_ATTESTATION}' WHEN 2 THEN '{fv.TYPE_TOMBSTONE}'
            WHEN 3 THEN '{fv.ATTESTATION_PREFIXES[0]}insurance' WHEN 4 THEN '{fv.ATTESTATION_PREFIXES[1]}'
            WHEN 5 THEN '{fv.TYPE_SIGNALS}' WHEN 6 THEN '{fv.ATTESTATION_PREFIXES[1]}a.b' ELSE '{fv.TYPE_ATTESTATION}' END AS type,
       CAST(event_id AS STRING) AS id, '' AS producer,
       CASE WHEN event_id % 19 = 0 THEN ts + INTERVAL '1' HOUR ELSE ts END AS time,
       CASE WHEN event_id % 23 = 0 THEN 'image/png' WHEN event_id % 29 = 0 THEN 'text/plain' END AS datacontenttype,
       CASE WHEN event_id % 23 = 0 THEN '' ELSE concat('{{"voidsId":"', CAST(event_id - 1 AS STRING), '"}}') END AS data,
       CASE WHEN event_id % 23 = 0 THEN 'aGVsbG8=' ELSE '' END AS data_base64,
       event_id % 31 <> 0 AS signature_valid
FROM {{events}}
"""


@query(
    "normalize_attestations",
    f"""WITH a AS ({oracle(ATTESTATIONS)}),
s AS (SELECT *, CASE WHEN source = '' THEN caller ELSE source END AS resolved, data_base64 <> '' AS b64 FROM a),
j AS (SELECT *, CASE
   WHEN time > ingest_time + INTERVAL '300' SECOND THEN 'future_time'
   WHEN subject = 'no-did' THEN 'invalid_subject'
   WHEN resolved = 'not-an-address' THEN 'invalid_source'
   WHEN NOT b64 AND coalesce(datacontenttype, 'application/json') <> 'application/json' THEN 'content_type_not_json'
   WHEN type IN ('{fv.TYPE_SIGNALS}', '{fv.ATTESTATION_PREFIXES[1]}') THEN 'unsupported_type'
   WHEN NOT signature_valid THEN 'invalid_signature'
   WHEN type = '{fv.TYPE_TOMBSTONE}' AND data = '' THEN 'tombstone_data_required'
   ELSE '' END AS reject_reason FROM s)
SELECT event_id, reject_reason, subject, resolved AS source,
       CASE WHEN type = '' THEN '{fv.TYPE_ATTESTATION}' ELSE type END AS type,
       CASE WHEN reject_reason = '' AND type = '{fv.TYPE_TOMBSTONE}' THEN CAST(event_id - 1 AS VARCHAR) ELSE '' END AS voids_id
FROM j""",
)
def normalize_attestations(spark, d):
    rows = adapt(spark, d, ATTESTATIONS, ("ingest_time", "time"), heavy=True)
    text_null = F.lit(None).cast("string")
    rows = rows.withColumns(
        {
            "specversion": text_null,
            "dataschema": text_null,
            "dataversion": text_null,
            "signature": text_null,
            "extras": F.lit("{}"),
            "tags": F.lit(None).cast("array<string>"),
        }
    )
    out = attest.normalize_attestations(rows)
    return out.select(
        "event_id",
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
        F.lower("subject").alias("subject"),
        F.lower("source").alias("source"),
        "type",
        F.coalesce("voids_id", F.lit("")).alias("voids_id"),
    )


# ---- rows, keys, routes -----------------------------------------------------


@query(
    "to_raw_row",
    f"""WITH {R}
SELECT id, subject, epoch_ms(time) AS time_ms, type, source, producer,
  CASE WHEN CAST(id AS BIGINT) % 3 = 0 AND CAST(id AS BIGINT) % 5 = 0 THEN concat('{{"tags":["a","t', CAST(id AS BIGINT) % 4, '"],"signature":"0x', id, '"}}')
       WHEN CAST(id AS BIGINT) % 3 = 0 THEN concat('{{"tags":["a","t', CAST(id AS BIGINT) % 4, '"]}}')
       WHEN CAST(id AS BIGINT) % 5 = 0 THEN concat('{{"signature":"0x', id, '"}}') ELSE '{{}}' END AS extras,
  CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN '' ELSE data END AS data,
  CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN 'SGVsbG8=' ELSE '' END AS data_base64,
  coalesce(voids_id, '') AS voids_id
FROM raw""",
)
def to_raw_row(spark, d):
    n = F.col("id").cast("long")
    rows = raw_events(spark, d, heavy=True).withColumns(
        {
            "datacontenttype": F.col("data_content_type"),
            "dataversion": F.col("data_version"),
            "dataschema": F.lit(""),
            "signature": F.when(n % 5 == 0, F.concat(F.lit("0x"), F.col("id"))),
            "tags": F.when(n % 3 == 0, F.array(F.lit("a"), F.concat(F.lit("t"), (n % 4).cast("string")))),
            "extras": F.lit("{}"),
            "data_base64": F.when(n % 4 == 0, F.lit("SGVsbG8=")),
            "data_index_key": F.lit(""),
        }
    )
    out = normalize.to_raw_row(rows)
    blank = F.lit("")
    return out.select(
        "id",
        "subject",
        millis("time"),
        "type",
        "source",
        "producer",
        "extras",
        F.coalesce("data", blank).alias("data"),
        F.coalesce(F.decode("data_base64", "UTF-8"), blank).alias("data_base64"),
        F.coalesce("voids_id", blank).alias("voids_id"),
    )


@query(
    "event_ids",
    f"""WITH {R}, k AS (SELECT *, {KEY_SQL} AS event_key FROM raw)
SELECT id, event_key, sha256(event_key) AS message_id, substring(sha256(concat(event_key, '|', type)), 1, 32) AS decoded_id FROM k""",
)
def event_ids(spark, d):
    rows = raw_events(spark, d, heavy=True).withColumn("event_key", identity.event_key())
    return rows.select(
        "id",
        "event_key",
        identity.message_id().alias("message_id"),
        identity.decoded_id(F.col("event_key"), F.col("type")).alias("decoded_id"),
    )


@query(
    "name_tokens",
    """SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN '_' ELSE
  replace(replace(replace(replace(concat(p_type, '.', p_name, '*>'), ' ', '_'), '.', '_'), '*', '_'), '>', '_') END AS token FROM part""",
)
def name_tokens(spark, d):
    part = load(spark, d, "part")
    name = F.when(F.col("p_partkey") % 50 == 0, F.lit("")).otherwise(
        F.concat("p_type", F.lit("."), "p_name", F.lit("*>"))
    )
    return part.select("p_partkey", identity.name_token(name).alias("token"))


_FNV_SQL = """list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(range(1, length(subject) + 1),
  lambda i: CAST(ascii(substr(subject, CAST(i AS INTEGER), 1)) AS BIGINT))), lambda h, b: (xor(h, b) * 16777619) % 4294967296)"""


@query(
    "routes",
    f"""WITH {R}, f AS (SELECT *, {_FNV_SQL} AS h FROM raw)
SELECT id, concat('{fv.ROUTE_ROOT}.', replace(type, '.', '_'), '.', subject, '.p', lpad(CAST(h % 16 AS VARCHAR), 3, '0')) AS route,
       CAST(h % 16 AS INTEGER) AS route_partition,
       concat('{fv.ROUTE_ROOT}.', replace(type, '.', '_'), '.>') AS type_filter FROM f""",
)
def routes(spark, d):
    return raw_events(spark, d, heavy=True).select(
        "id",
        identity.route_subject(F.col("type"), F.col("subject"), 16).alias("route"),
        identity.route_partition(F.col("subject"), 16).alias("route_partition"),
        identity.route_filter_for_type(F.col("type")).alias("type_filter"),
    )


@query(
    "did_parts",
    f"""SELECT event_id, '{CHAIN}' AS chain, '{CONTRACT}' AS contract, CAST(user_id AS VARCHAR) AS token,
  concat('{DID}', user_id) AS canonical, event_id % 2 = 0 AS is_vehicle FROM events""",
)
def did_parts(spark, d):
    # Two of three are in the legacy form; token numbers come with a leading zero.
    legacy = F.col("event_id") % 2 == 1
    token = F.concat(F.lit("0"), F.col("user_id").cast("string"))
    did = F.when(legacy, F.concat(F.lit(LEGACY), token)).otherwise(F.concat(F.lit(DID), token))
    rows = load(spark, d, "events").select("event_id", did.alias("did"))
    return rows.select(
        "event_id",
        identity.did_parts(F.col("did"))["chain"].alias("chain"),
        identity.did_parts(F.col("did"))["contract"].alias("contract"),
        identity.did_parts(F.col("did"))["token"].alias("token"),
        F.lower(identity.canonical_did(F.col("did"))).alias("canonical"),
        identity.is_vehicle_subject(F.col("did"), CHAIN, CONTRACT).alias("is_vehicle"),
    )


# The mixed-case examples published with the address checksum.
_PUBLISHED = [
    "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed",
    "0xfB6916095ca1df60bB79Ce92cE3Ea74c37c5d359",
    "0xdbF03B407c01E7cD3CBea99509d93f8DDDC8C6FB",
    "0xD1220A0cf47c7B9Be7A2E6BA89F429762e7b9aDb",
]


@query(
    "checksum_addresses",
    f"""SELECT DISTINCT user_id, list_extract({_PUBLISHED}, CAST(user_id % 4 + 1 AS INTEGER)) AS address,
       true AS same_digits, true AS settled FROM events""",
)
def checksum_addresses(spark, d):
    """Published addresses found again from lower case, and for an address of each user's
    own: the checksum changes letters only, and changes nothing the second time."""
    users = load(spark, d, "events").select("user_id").distinct()
    known = F.lower(F.element_at(F.array(*map(F.lit, _PUBLISHED)), (F.col("user_id") % 4 + 1).cast("int")))
    plain = F.concat(F.lit("0x"), F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 40))
    found = users.select(
        "user_id", identity.canonical_address(known).alias("address"), plain.alias("plain"), identity.canonical_address(plain).alias("own")
    )
    again = identity.canonical_address(F.col("own"))
    return found.select("user_id", "address", (F.lower("own") == F.col("plain")).alias("same_digits"), (again == F.col("own")).alias("settled"))


@query(
    "header_sizes",
    """SELECT event_id, length('{"id":"' || event_id || '"}') + length('{"x":"' || repeat('a', CAST(8100 + event_id % 200 AS INTEGER)) || '"}') - 2 <= 8192 AS fits FROM events""",
)
def header_sizes(spark, d):
    """Headers around the size limit."""
    rows = load(spark, d, "events").select("event_id")
    header = {name: F.lit(None).cast("string") for name in normalize.HEADER_NAMES}
    header["id"] = F.col("event_id").cast("string")
    filler = F.expr("repeat('a', CAST(8100 + event_id % 200 AS INT))")
    header["extras"] = F.concat(F.lit('{"x":"'), filler, F.lit('"}'))
    return rows.select("event_id", (normalize.header_bytes(header) <= fv.MAX_HEADER_BYTES).alias("fits"))


# ---- payload split ----------------------------------------------------------

SPLIT_AT = 4096


def _documents(spark, d):
    doc = load(spark, d, "documents")
    return doc.select(
        "doc_id",
        F.concat(F.lit(DID), F.col("doc_id").cast("string")).alias("subject"),
        F.lit(fv.TYPE_ATTESTATION).alias("type"),
        F.col("doc_id").cast("string").alias("id"),
        F.lit(SOURCE).alias("source"),
        as_of().alias("time"),
        as_of().alias("ingest_time"),
        F.col("text").alias("data"),
        F.lit(None).cast("string").alias("data_base64"),
        F.lit(None).cast("string").alias("data_index_key"),
    )


_BLOB_SQL = f"""
SELECT doc_id, strlen(text) AS n, sha256(concat('{DID}', doc_id, '|2024-02-01T00:00:00.000Z|{fv.TYPE_ATTESTATION}|{SOURCE}|', doc_id, '|', sha256(text))) AS h,
       md5(text) AS digest FROM documents"""


@query(
    "split_payloads",
    f"""WITH b AS ({_BLOB_SQL})
SELECT doc_id, n > {SPLIT_AT} AS is_external, CASE WHEN n > {SPLIT_AT} THEN
  concat('{fv.BLOB_PREFIX}', '{DID}', doc_id, '/2024/02/01/', substring(h, 1, 8), '-', substring(h, 9, 4), '-',
         substring(h, 13, 4), '-', substring(h, 17, 4), '-', substring(h, 21, 12)) ELSE '' END AS data_index_key FROM b""",
)
def split_payloads(spark, d):
    stored, _, _ = payloads.split_payloads(_documents(spark, d), SPLIT_AT)
    return stored.select(
        "doc_id",
        F.col("data").isNull().alias("is_external"),
        F.coalesce("data_index_key", F.lit("")).alias("data_index_key"),
    )


@query(
    "split_blobs",
    f"""WITH b AS ({_BLOB_SQL}) SELECT substring(h, 1, 8) AS object, CAST(n AS INTEGER) AS size, digest FROM b WHERE n > {SPLIT_AT}""",
)
def split_blobs(spark, d):
    _, blobs, _ = payloads.split_payloads(_documents(spark, d), SPLIT_AT)
    return blobs.select(
        F.substring(F.regexp_extract("data_index_key", "([^/]+)$", 1), 1, 8).alias("object"),
        F.octet_length("payload").alias("size"),
        F.md5("payload").alias("digest"),
    )


@query("rehydrate_payloads", "SELECT doc_id, md5(text) AS digest FROM documents")
def rehydrate_payloads(spark, d):
    stored, blobs, _ = payloads.split_payloads(_documents(spark, d), SPLIT_AT)
    stored = stored.withColumn("data_base64", F.col("data_base64").cast("binary"))
    return payloads.rehydrate_payloads(stored, blobs).select("doc_id", F.md5("payload").alias("digest"))


SEAL_KEY = "KioqKioqKioqKioqKioqKioqKioqKioqKioqKioqKio="


@query(
    "seal_and_open",
    "SELECT doc_id, md5(text) AS digest, true AS sealed, CAST(strlen(text) + 32 AS INTEGER) AS sealed_size, true AS wrong_path_fails, true AS wrong_key_fails FROM documents",
)
def seal_and_open(spark, d):
    doc = load(spark, d, "documents")
    aad = F.concat(F.lit("blobs/"), F.col("doc_id").cast("string"))
    sealed = doc.select(
        "doc_id", aad.alias("aad"), sealing.seal(F.encode("text", "UTF-8"), SEAL_KEY, aad).alias("blob")
    )
    opened = sealing.open_sealed(F.col("blob"), SEAL_KEY, F.col("aad"))
    moved = sealing.open_sealed(F.col("blob"), SEAL_KEY, F.lit("elsewhere"))
    other = sealing.open_sealed(F.col("blob"), SEAL_KEY[::-1].strip("=") + "=" * SEAL_KEY.count("="), F.col("aad"))
    return sealed.select(
        "doc_id",
        F.md5(opened).alias("digest"),
        sealing.is_sealed(F.col("blob")).alias("sealed"),
        F.octet_length("blob").alias("sealed_size"),
        sealing.open_failed(F.col("blob"), moved).alias("wrong_path_fails"),
        sealing.open_failed(F.col("blob"), other).alias("wrong_key_fails"),
    )


@query(
    "poison_rows",
    f"""SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'invalid_utf8' WHEN doc_id % 19 = 0 THEN 'unserializable_header' ELSE '' END AS fault FROM documents""",
)
def poison_rows(spark, d):
    doc = _documents(spark, d)
    broken = F.concat(F.encode("data", "UTF-8"), F.lit(b"\xff\xfe")).cast("string")
    rows = doc.withColumns(
        {
            "data": F.when(F.col("doc_id") % 17 == 0, broken).otherwise(F.col("data")),
            "type": F.when(F.col("doc_id") % 19 == 0, F.lit("")).otherwise(F.col("type")),
        }
    )
    return rows.select("doc_id", F.coalesce(normalize.poison_fault(), F.lit("")).alias("fault"))


@query(
    "payload_lengths",
    """SELECT doc_id, CAST(CASE WHEN doc_id % 2 = 0 THEN floor(length(to_base64(encode(text))) / 4) * 3 ELSE strlen(text) END AS BIGINT) AS payload_bytes FROM documents""",
)
def payload_lengths(spark, d):
    doc = load(spark, d, "documents")
    encoded = F.when(F.col("doc_id") % 2 == 0, F.translate(F.base64(F.encode("text", "UTF-8")), "\r\n", ""))
    return doc.select(
        "doc_id", checks.payload_length(F.col("text"), encoded).cast("long").alias("payload_bytes")
    )


@query(
    "valid_base64",
    "SELECT doc_id, doc_id % 13 <> 0 AS decodable FROM documents",
)
def valid_base64(spark, d):
    doc = load(spark, d, "documents")
    encoded = F.translate(F.base64(F.encode("text", "UTF-8")), "\r\n", "")
    broken = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("!"), encoded)).otherwise(encoded)
    return doc.select("doc_id", checks.valid_base64(broken).alias("decodable"))


@query(
    "valid_lat_lon",
    """SELECT event_id, abs(value - 100) <= 90 AND abs(value * 2 - 300) <= 180 AND NOT (value = 100 AND value * 2 = 300) AS usable FROM events""",
)
def valid_lat_lon(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", checks.valid_lat_lon(F.col("value") - 100, F.col("value") * 2 - 300).alias("usable"))


@query(
    "parse_size",
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN CAST(p_size AS BIGINT) WHEN 1 THEN CAST(p_size AS BIGINT) * 1048576 WHEN 2 THEN CAST(p_size AS BIGINT) * 1073741824
  WHEN 3 THEN CAST(p_size AS BIGINT) * 1024 WHEN 4 THEN CAST(floor((p_size + 0.5) * 1073741824) AS BIGINT) WHEN 5 THEN 0 WHEN 6 THEN 0
  ELSE CAST(p_size AS BIGINT) * 1099511627776 END AS bytes FROM part""",
)
def parse_size(spark, d):
    part = load(spark, d, "part")
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in ["", "MB", " GiB ", "kb", ".5GB", "%", "x", "TB"]]),
        (F.col("p_partkey") % 8 + 1).cast("int"),
    )
    return part.select("p_partkey", text.parse_size(F.concat(F.col("p_size").cast("string"), suffix)).alias("bytes"))


# ---- reads, dedup, joins ----------------------------------------------------


@query(
    "read_raw_events",
    f"""WITH {R} SELECT id, subject, epoch_ms(time) AS time_ms, data FROM raw
WHERE type = '{fv.TYPE_STATUS}' AND time >= TIMESTAMP '2024-01-05 06:00:00' AND time < TIMESTAMP '2024-01-20 18:30:00'""",
)
def read_raw_events(spark, d):
    rows = with_partition_columns(raw_events(spark, d)).where(
        (F.col("type") == fv.TYPE_STATUS) & date_predicate(datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18, 30))
    )
    return rows.select("id", "subject", millis("time"), "data")


@query(
    "sample_events",
    f"WITH {R} SELECT id, data FROM raw WHERE data IS NOT NULL ORDER BY time, id LIMIT 50",
)
def sample(spark, d):
    return sample_events(raw_events(spark, d), 50).select("id", "data")


@query(
    "dedup_latest",
    f"""WITH {RD}, n AS (SELECT *, row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY snapshot_id DESC) AS rn FROM raw)
SELECT id, subject, epoch_ms(time) AS time_ms, type, data, snapshot_id FROM n WHERE rn = 1""",
)
def dedup_latest(spark, d):
    return dedup.dedup_latest(raw_events_dup(spark, d)).select(
        "id", "subject", millis("time"), "type", "data", "snapshot_id"
    )


@query(
    "duplicate_volume",
    f"""WITH {RD}, k AS (SELECT type, CAST(time AS DATE) AS day, {KEY_SQL} AS k, count(*) AS n FROM raw GROUP BY ALL)
SELECT type, CAST(day AS VARCHAR) AS day, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicates, max(n) AS max_copies FROM k GROUP BY ALL""",
)
def duplicate_volume(spark, d):
    return dedup.duplicate_volume(raw_events_dup(spark, d)).withColumn("day", F.col("day").cast("string"))


@query(
    "append_unseen",
    f"""WITH {RD} SELECT DISTINCT id, subject, type FROM raw
WHERE {KEY_SQL} NOT IN (SELECT {KEY_SQL} FROM raw WHERE type = '{fv.TYPE_STATUS}' OR CAST(id AS BIGINT) % 3 = 0)""",
)
def append_unseen(spark, d):
    new = raw_events_dup(spark, d)
    target = new.where((F.col("type") == fv.TYPE_STATUS) | (F.col("id").cast("long") % 3 == 0))
    return dedup.unseen_rows(new, target, identity.KEY_FIELDS).select("id", "subject", "type")


@query(
    "void_resolution",
    f"""WITH {R} SELECT id, subject, type FROM raw r WHERE type = '{fv.TYPE_TOMBSTONE}' OR NOT EXISTS (
  SELECT 1 FROM raw t WHERE t.type = '{fv.TYPE_TOMBSTONE}' AND t.voids_id = r.id AND t.subject = r.subject)""",
)
def void_resolution(spark, d):
    return dedup.void_resolution(raw_events(spark, d)).select("id", "subject", "type")


@query(
    "ingest_lag",
    f"""WITH {R}, f AS (SELECT *, CAST({_FNV_SQL} % 8 AS INTEGER) AS route_partition FROM raw)
SELECT route_partition, count(*) AS pending_rows, false AS breached FROM f WHERE snapshot_id >= 60 GROUP BY 1""",
)
def ingest_lag(spark, d):
    accepted = raw_events(spark, d).withColumn("route_partition", identity.route_partition(F.col("subject"), 8))
    table = raw_events_dup(spark, d).where(F.col("snapshot_id") < 60)
    # A second arrival in snapshot 60 belongs to a first one in 59, which is stored.
    return dedup.ingest_lag(accepted, table)


@query(
    "table_counts",
    f"""WITH {R} SELECT type, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS events, count(DISTINCT subject) AS subjects FROM raw GROUP BY ALL""",
)
def table_counts(spark, d):
    return reports.table_counts(raw_events(spark, d)).withColumn("day", F.col("day").cast("string"))


# At these sizes a sketch still holds every subject, so its estimate is the count itself.
@query("table_counts_approximate", ORACLES["table_counts"])
def table_counts_approximate(spark, d):
    return reports.table_counts_approximate(raw_events(spark, d)).withColumn("day", F.col("day").cast("string"))


@query(
    "sketched_counts",
    f"""WITH {R} SELECT CAST(CAST(date_trunc('week', time) AS DATE) AS VARCHAR) AS week, type = '{fv.TYPE_STATUS}' AS is_status,
  count(*) AS events, count(DISTINCT subject) AS subjects FROM raw GROUP BY ALL""",
)
def sketched_counts(spark, d):
    """Distinct subjects per week from daily sketches that were stored and read again."""
    stored = scratch_path(spark, "sketches")
    reports.subject_sketches(raw_events(spark, d)).write.parquet(stored)
    sketches = spark.read.schema("type string, day date, events long, sketch binary").parquet(stored)
    week = F.date_trunc("week", F.col("day")).cast("date").cast("string").alias("week")
    return reports.sketched_counts(sketches, week, (F.col("type") == fv.TYPE_STATUS).alias("is_status"))


@query(
    "union_backfilled",
    f"""WITH {R} SELECT id, data, coalesce(voids_id, '') AS voids_id FROM raw WHERE snapshot_id >= 50
UNION ALL SELECT id, data, '' AS voids_id FROM raw WHERE snapshot_id < 50""",
)
def union_backfilled(spark, d):
    rows = raw_events(spark, d)
    native = rows.where("snapshot_id >= 50")
    older = rows.where("snapshot_id < 50").drop("voids_id")
    out = union_native_and_backfilled(native, older)
    return out.select("id", "data", F.coalesce("voids_id", F.lit("")).alias("voids_id"))


@query(
    "throttle_first",
    """WITH RECURSIVE t AS (SELECT DISTINCT event_type AS producer, epoch_ms(date_trunc('millisecond', ts)) AS ms FROM events),
e AS (SELECT producer, min(ms) AS emitted_ms FROM t GROUP BY 1
  UNION ALL SELECT e.producer, (SELECT min(t.ms) FROM t WHERE t.producer = e.producer AND t.ms >= e.emitted_ms + 3600000) AS emitted_ms
  FROM e WHERE (SELECT max(t.ms) FROM t WHERE t.producer = e.producer) >= e.emitted_ms + 3600000)
SELECT producer, emitted_ms FROM e WHERE emitted_ms IS NOT NULL""",
)
def throttle(spark, d):
    rows = load(spark, d, "events").select(F.col("event_type").alias("producer"), F.col("ts").cast("timestamp").alias("ts"))
    return throttle_first(rows, "producer", F.col("ts"))


@query(
    "subject_order_check",
    """WITH s AS (SELECT user_id, event_id, ts, ts - (event_id % 5) * INTERVAL '3' HOUR AS stored FROM events),
l AS (SELECT *, lag(stored) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM s)
SELECT user_id, count(*) AS row_count, CAST(sum(CASE WHEN before > stored THEN 1 ELSE 0 END) AS BIGINT) AS order_breaks FROM l GROUP BY 1""",
)
def subject_order_check(spark, d):
    rows = load(spark, d, "events").selectExpr(
        "user_id", "event_id", "ts", "ts - (event_id % 5) * INTERVAL '3' HOUR AS stored"
    )
    return ordered.order_breaks(rows, "user_id", ["ts", "event_id"], "stored", F.date_trunc("day", F.col("ts")))
