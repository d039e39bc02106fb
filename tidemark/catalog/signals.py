"""Queries over decoded signals. Each given event becomes one status message whose
payload holds eight elements with mixed names, order, copies, gaps and faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.catalog.common import CHAIN, CONTRACT, DID, ROWS_OF_A_TASK, SOURCE, load

from tidemark.operators import decode
from tidemark.session import spread

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


ODD_NAME = "fuel.level *x"
NAMES = [fv.SIGNAL_LATITUDE, fv.SIGNAL_LONGITUDE, fv.SIGNAL_HDOP, "speed", ODD_NAME]
FOREIGN = "did:erc721:137:0x00000000000000000000000000000000000000aa:"


def status_events(spark, d):
    """Raw status rows with JSON payloads derived from the given events."""
    e = spread(load(spark, d, "events"), ROWS_OF_A_TASK)
    eid, base = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp"))

    def element(k):
        n = (eid * 7 + k * k) % 5
        name = F.element_at(F.array(*[F.lit(x) for x in NAMES]), (n + 1).cast("int"))
        offset = ((eid * (k + 3) * 37) % 13) * 130_000 + F.when((eid + 5 * k) % 31 == 0, 600_000_000).otherwise(0)
        time = F.date_format(F.timestamp_micros(base + offset), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        value = (F.col("value") * (k + 1) / 8 - 60).cast("string")
        return F.struct(
            F.when((eid + 3 * k) % 29 == 0, F.lit("")).otherwise(name).alias("name"),
            F.when((eid + 2 * k) % 23 == 0, F.lit("never")).otherwise(time).alias("timestamp"),
            F.when((eid + k) % 19 == 0, F.lit("n/a")).otherwise(value).alias("value"),
        )

    return e.select(
        F.when(eid % 13 == 0, F.lit(FOREIGN)).otherwise(F.lit(DID)).alias("_did"),
        eid.alias("event_id"),
        F.col("user_id").cast("string").alias("_user"),
        F.to_json(F.struct(F.transform(F.sequence(F.lit(0), F.lit(7)), element).alias("signals"))).alias("data"),
        F.col("ts").cast("timestamp").alias("ingest_time"),
    ).select(
        "event_id",
        F.concat("_did", "_user").alias("subject"),
        F.date_trunc("millisecond", "ingest_time").alias("time"),
        F.lit(fv.TYPE_STATUS).alias("type"),
        F.col("event_id").cast("string").alias("id"),
        F.lit(SOURCE).alias("source"),
        F.concat("_did", "_user").alias("producer"),
        F.lit("default/v1.0").alias("data_version"),
        "data",
        "ingest_time",
    )


_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"

# Elements with their faults, then good ones, pruned ones, and the coordinate walk.
ELEMENTS = f"""
el AS (
  SELECT event_id, user_id, ts, k AS pos,
         CASE WHEN (event_id + 3 * k) % 29 = 0 THEN '' ELSE {_NAME_LIST}[(event_id * 7 + k * k) % 5 + 1] END AS name,
         CASE WHEN (event_id + 2 * k) % 23 <> 0 THEN epoch_us(ts) + ((event_id * (k + 3) * 37) % 13) * 130000
              + CASE WHEN (event_id + 5 * k) % 31 = 0 THEN 600000000 ELSE 0 END END AS us,
         CASE WHEN (event_id + k) % 19 <> 0 THEN value * (k + 1) / 8 - 60 END AS value
  FROM events, range(8) r(k) WHERE event_id % 13 <> 0),
good AS (SELECT * FROM el WHERE name <> '' AND us IS NOT NULL AND value IS NOT NULL),
pruned AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id, name, us ORDER BY pos DESC) AS rn FROM good) x
  WHERE rn = 1 AND us <= epoch_us(ts) + 300000000)"""

_LAT, _LON, _HDOP = fv.SIGNAL_LATITUDE, fv.SIGNAL_LONGITUDE, fv.SIGNAL_HDOP
WALK = f"""
seq AS (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY event_id ORDER BY us, name) AS n, us, name, value
  FROM pruned WHERE name IN ('{_LAT}', '{_LON}', '{_HDOP}')),
ends AS (
  SELECT * FROM seq UNION ALL
  SELECT event_id, any_value(user_id), max(n) + 1, NULL, 'end', NULL FROM seq GROUP BY event_id),
walk AS (
  SELECT event_id, user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon,
         CAST(NULL AS DOUBLE) AS hdop, CAST(NULL AS BIGINT) AS first_us, false AS closed,
         CAST(NULL AS DOUBLE) AS c_lat, CAST(NULL AS DOUBLE) AS c_lon, CAST(NULL AS DOUBLE) AS c_hdop, CAST(NULL AS BIGINT) AS c_us
  FROM (SELECT DISTINCT event_id, user_id FROM seq) s
  UNION ALL
  SELECT event_id, user_id, n,
         CASE WHEN name = '{_LAT}' THEN value WHEN close THEN NULL ELSE lat END,
         CASE WHEN name = '{_LON}' THEN value WHEN close THEN NULL ELSE lon END,
         CASE WHEN name = '{_HDOP}' THEN value WHEN close THEN NULL ELSE hdop END,
         CASE WHEN close OR first_us IS NULL THEN us ELSE first_us END,
         close, CASE WHEN close THEN lat END, CASE WHEN close THEN lon END, CASE WHEN close THEN hdop END,
         CASE WHEN close THEN first_us END
  FROM (SELECT e.event_id, e.user_id, e.n, e.us, e.name, e.value, w.lat, w.lon, w.hdop, w.first_us,
               w.first_us IS NOT NULL AND (e.name = 'end' OR e.us - w.first_us >= 500000
                 OR (e.name = '{_LAT}' AND w.lat IS NOT NULL) OR (e.name = '{_LON}' AND w.lon IS NOT NULL)
                 OR (e.name = '{_HDOP}' AND w.hdop IS NOT NULL)) AS close
        FROM walk w JOIN ends e ON e.event_id = w.event_id AND e.n = w.n + 1) step),
triples AS (
  SELECT *, c_lat IS NOT NULL AND c_lon IS NOT NULL AS pair,
         coalesce(abs(c_lat) <= 90 AND abs(c_lon) <= 180 AND NOT (c_lat = 0 AND c_lon = 0), false) AS usable
  FROM walk WHERE closed),
located AS (SELECT event_id, user_id, c_us AS us, c_lat AS lat, c_lon AS lon, coalesce(c_hdop, 0) AS hdop FROM triples WHERE pair AND usable),
merged AS (
  SELECT event_id, user_id, name, us, value, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS hdop
  FROM pruned WHERE name NOT IN ('{_LAT}', '{_LON}', '{_HDOP}')
  UNION ALL SELECT event_id, user_id, '{fv.SIGNAL_LOCATION}', us, NULL, lat, lon, hdop FROM located)"""

MISSING = -1e9


def signal_rows(df):
    return decode.inline_rows(df, "signals", "event_id")


def _value(c, name):
    return F.coalesce(F.col(c), F.lit(MISSING)).alias(name)


@query(
    "decode_signals",
    f"WITH {ELEMENTS} SELECT event_id, name, us, CAST(pos AS INTEGER) AS pos, value FROM good",
)
def decode_signals(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    return decoded.transform(signal_rows).select(
        "event_id", "name", F.unix_micros("timestamp").alias("us"), "pos", "value"
    )


@query(
    "decode_errors",
    f"""WITH {ELEMENTS} SELECT event_id, CASE WHEN name = '' THEN 'missing_name' WHEN us IS NULL THEN 'bad_timestamp' ELSE 'bad_value' END AS reason, count(*) AS n
FROM el WHERE name = '' OR us IS NULL OR value IS NULL GROUP BY ALL""",
)
def decode_errors(spark, d):
    _, errors = decode.decode_signals(status_events(spark, d), CHAIN, CONTRACT)
    event = F.regexp_extract("event_key", r"\|([0-9]+)\z", 1).cast("long").alias("event_id")
    return errors.groupBy(event, "reason").agg(F.count("*").alias("n"))


_PRUNED_SQL = f"WITH {ELEMENTS} SELECT event_id, name, us, value FROM pruned"


@query("prune_signals", _PRUNED_SQL)
def prune_signals(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    pruned = decode.with_pruned(decoded, F.col("ingest_time"))
    return pruned.transform(signal_rows).select(
        "event_id", "name", F.unix_micros("timestamp").alias("us"), "value"
    )


@query("prune_signals_long", _PRUNED_SQL)
def prune_signals_long(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    rows = decode.inline_rows(decoded, "signals", "event_id", "ingest_time")
    return decode.prune_long(rows, F.col("ingest_time"), "event_id").select(
        "event_id", "name", F.unix_micros("timestamp").alias("us"), "value"
    )


def _merged(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    return decode.merge_coordinates(decode.with_pruned(decoded, F.col("ingest_time")))


@query(
    "merge_coordinates",
    f"""WITH RECURSIVE {ELEMENTS}, {WALK}
SELECT event_id, name, us, coalesce(value, {MISSING}) AS value, coalesce(lat, {MISSING}) AS lat,
       coalesce(lon, {MISSING}) AS lon, coalesce(hdop, {MISSING}) AS hdop FROM merged""",
)
def merge_coordinates(spark, d):
    return _merged(spark, d).transform(signal_rows).select(
        "event_id",
        "name",
        F.unix_micros("timestamp").alias("us"),
        _value("value", "value"),
        _value("location.lat", "lat"),
        _value("location.lon", "lon"),
        _value("location.hdop", "hdop"),
    )


@query(
    "coordinate_errors",
    f"""WITH RECURSIVE {ELEMENTS}, {WALK},
f AS (SELECT CASE WHEN pair AND NOT usable THEN 'invalid_coordinate' WHEN pair THEN NULL WHEN c_lat IS NOT NULL THEN 'unpaired_latitude'
  WHEN c_lon IS NOT NULL THEN 'unpaired_longitude' END AS reason FROM triples)
SELECT reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY 1""",
)
def coordinate_errors(spark, d):
    errors = _merged(spark, d).select(F.explode_outer("location_errors").alias("reason"))
    errors = errors.where("reason IS NOT NULL")
    return errors.groupBy("reason").agg(F.count("*").alias("n"))


_KEY_OF = f"concat('{DID}', user_id, '|', strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ'), '|{fv.TYPE_STATUS}|{SOURCE}|', event_id)"
_TOKEN_OF = "replace(replace(replace(name, ' ', '_'), '.', '_'), '*', '_')"


@query(
    "decode_packed",
    f"""WITH RECURSIVE {ELEMENTS}, {WALK},
g AS (SELECT event_id, name, count(*) AS n_signals, min(us) AS first_us, max(us) AS last_us,
             string_agg(CAST(us AS VARCHAR), ',' ORDER BY us) AS times FROM merged GROUP BY ALL),
k AS (SELECT g.*, {_KEY_OF} AS key FROM g JOIN events USING (event_id))
SELECT event_id, name, {_TOKEN_OF} AS name_token, substring(sha256(concat(key, '|', name)), 1, 32) AS dedup_id,
       '{fv.TYPE_SIGNALS}' AS header_type, n_signals, first_us, last_us, md5(times) AS order_digest FROM k""",
)
def decode_packed(spark, d):
    packed = decode.decode_packed(status_events(spark, d), CHAIN, CONTRACT, F.col("ingest_time"))
    us = lambda x: F.unix_micros(x["timestamp"])
    times = F.transform("signals", us)
    return packed.select(
        F.col("header.id").cast("long").alias("event_id"),
        "name",
        "name_token",
        "dedup_id",
        F.col("header.type").alias("header_type"),
        F.size("signals").cast("long").alias("n_signals"),
        F.array_min(times).alias("first_us"),
        F.array_max(times).alias("last_us"),
        F.md5(F.array_join(F.transform(times, lambda t: t.cast("string")), ",")).alias("order_digest"),
    )


@query(
    "unpack_signals",
    f"""WITH RECURSIVE {ELEMENTS}, {WALK} SELECT event_id, name, us, coalesce(value, {MISSING}) AS value FROM merged""",
)
def unpack_signals(spark, d):
    packed = decode.decode_packed(status_events(spark, d), CHAIN, CONTRACT, F.col("ingest_time"))
    rows = decode.unpack(packed.withColumn("event_id", F.col("header.id").cast("long")))
    return rows.select("event_id", "name", F.unix_micros("timestamp").alias("us"), _value("value", "value"))


@query(
    "pack_long",
    f"""WITH {ELEMENTS} SELECT event_id, name, count(*) AS n_signals, md5(string_agg(CAST(us AS VARCHAR), ',' ORDER BY us)) AS order_digest FROM pruned GROUP BY ALL""",
)
def pack_long(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    rows = decode.inline_rows(decoded, "signals", "event_id", "ingest_time")
    packed = decode.pack_long(decode.prune_long(rows, F.col("ingest_time"), "event_id"), "event_id")
    times = F.transform("signals", lambda x: F.unix_micros(x["timestamp"]).cast("string"))
    return packed.select(
        "event_id", "name", F.size("signals").cast("long").alias("n_signals"), F.md5(F.array_join(times, ",")).alias("order_digest")
    )


@query(
    "signals_by_lane",
    f"""WITH RECURSIVE {ELEMENTS}, {WALK}
SELECT {_TOKEN_OF} AS name_token, count(DISTINCT event_id) AS messages, count(*) AS signals FROM merged GROUP BY 1""",
)
def signals_by_lane(spark, d):
    packed = decode.decode_packed(status_events(spark, d), CHAIN, CONTRACT, F.col("ingest_time"))
    return packed.groupBy("name_token").agg(
        F.count("*").alias("messages"), F.sum(F.size("signals")).alias("signals")
    )


@query(
    "latest_signals",
    f"""WITH {ELEMENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, name ORDER BY us DESC, pos DESC, value DESC) AS rn FROM good)
SELECT concat('{DID}', user_id) AS subject, name, us, CAST(pos AS INTEGER) AS pos, value FROM r WHERE rn = 1""",
)
def latest_signals(spark, d):
    decoded = decode.decode_arrays(status_events(spark, d), CHAIN, CONTRACT)
    rows = decode.inline_rows(decoded, "signals", "subject")
    return decode.latest_signals(rows).select("subject", "name", F.unix_micros("timestamp").alias("us"), "pos", "value")


def vehicle_event_rows(spark, d):
    """Events-type messages of three elements: two with a name and one in eleven broken."""
    rows = status_events(spark, d).withColumn("type", F.lit(fv.TYPE_EVENTS))
    eid = F.col("event_id")

    def element(k):
        name = F.when((eid + k) % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("harsh."), ((eid + k) % 4).cast("string")))
        return F.struct(
            name.alias("name"),
            F.date_format(F.timestamp_millis(F.unix_millis("time") + k * 1000), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
            k.alias("n"),
        )

    events = F.transform(F.sequence(F.lit(0), F.lit(2)), element)
    return rows.withColumn("data", F.to_json(F.struct(events.alias("events"))))


_VE = """v AS (SELECT event_id, k, CASE WHEN (event_id + k) % 11 = 0 THEN '' ELSE concat('harsh.', (event_id + k) % 4) END AS name,
  epoch_ms(date_trunc('millisecond', ts)) + k * 1000 AS ms FROM events, range(3) r(k))"""


@query("decode_vehicle_events", f"WITH {_VE} SELECT event_id, name, ms, k AS n FROM v WHERE name <> ''")
def decode_vehicle_events(spark, d):
    decoded = decode.decode_vehicle_events(vehicle_event_rows(spark, d))
    return decode.inline_rows(decoded, "events", "event_id").select(
        "event_id", "name", F.unix_millis("timestamp").alias("ms"), F.get_json_object("payload", "$.n").cast("long").alias("n")
    )


@query(
    "pack_vehicle_events",
    f"WITH {_VE} SELECT event_id, name, replace(name, '.', '_') AS name_token, count(*) AS n_events FROM v WHERE name <> '' GROUP BY ALL",
)
def pack_vehicle_events(spark, d):
    packed = decode.decode_packed_events(vehicle_event_rows(spark, d))
    return packed.select(
        F.col("header.id").cast("long").alias("event_id"), "name", "name_token", F.size("events").cast("long").alias("n_events")
    )
