"""Header defaults, validation and canonical form, as narrow column expressions.

The rules are written against an accessor ``get(name) -> Column`` so the same
expression checks a row's columns or one element of a header array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import checks, identity
from tidemark.functions.text import merge_json_objects

HEADER = (
    "struct<specversion:string,type:string,subject:string,source:string,producer:string,"
    "id:string,time:timestamp,datacontenttype:string,dataschema:string,dataversion:string,"
    "tags:array<string>,signature:string,extras:string>"
)
HEADER_NAMES = [
    "specversion",
    "type",
    "subject",
    "source",
    "producer",
    "id",
    "time",
    "datacontenttype",
    "dataschema",
    "dataversion",
    "tags",
    "signature",
    "extras",
]

Get = Callable[[str], Column]


def _filled(c: Column, default: Column) -> Column:
    return F.when(checks.is_blank(c), default).otherwise(c)


def defaulted(get: Get, source: Column, default_id: Column, now: Column, is_base64: Column) -> dict:
    """Header columns after defaults; the caller's identity becomes the source."""
    out = {name: get(name) for name in HEADER_NAMES}
    out["source"] = source
    out["subject"] = _filled(get("subject"), get("producer"))
    out["time"] = F.coalesce(get("time"), now)
    out["id"] = _filled(get("id"), default_id)
    out["specversion"] = _filled(get("specversion"), F.lit(fv.DEFAULT_SPEC_VERSION))
    out["datacontenttype"] = F.when(
        ~is_base64 & checks.is_blank(get("datacontenttype")), F.lit(fv.DEFAULT_CONTENT_TYPE)
    ).otherwise(get("datacontenttype"))
    return out


def header_bytes(header: dict) -> Column:
    """Serialised size of every header field, without the payload."""
    known = F.to_json(F.struct(*[c.alias(n) for n, c in header.items() if n != "extras"]))
    extras = F.coalesce(header["extras"], F.lit("{}"))
    return F.octet_length(known) + F.octet_length(extras) - 2


def header_fault(header: dict, is_base64: Column) -> Column:
    """Reason of the first failing header rule, NULL when all hold."""
    content = checks.content_type_fault(header["datacontenttype"], is_base64)
    steps = [
        ("invalid_id", checks.valid_identifier(header["id"])),
        ("invalid_specversion", checks.valid_identifier(header["specversion"])),
        ("invalid_datacontenttype", checks.valid_identifier(header["datacontenttype"])),
    ]
    for name in ["dataschema", "dataversion", "type", "subject", "producer"]:
        steps.append((f"invalid_{name}", checks.valid_optional_identifier(header[name])))
    steps.append(("header_too_large", header_bytes(header) <= fv.MAX_HEADER_BYTES))
    chain = None
    for label, ok in steps:
        chain = F.when(~ok, F.lit(label)) if chain is None else chain.when(~ok, F.lit(label))
    return F.coalesce(content, chain)


def connection_fault(header: dict, is_base64: Column) -> Column:
    """Header rules, then event type, identifiers and source address."""
    rest = (
        F.when(~checks.connection_type_ok(header["type"]), F.lit("unsupported_type"))
        .when(~checks.device_did_ok(header["subject"]), F.lit("invalid_subject"))
        .when(~checks.device_did_ok(header["producer"]), F.lit("invalid_producer"))
        .when(~checks.address_ok(header["source"]), F.lit("invalid_source"))
    )
    return F.coalesce(header_fault(header, is_base64), rest)


def canonical_columns(df: DataFrame, ethr: bool = False, producer: bool = True) -> DataFrame:
    """Rewrite subject, producer and source in checksummed canonical form."""
    columns = {
        "subject": identity.canonical_did(F.col("subject"), legacy=not ethr, ethr=ethr),
        "source": identity.canonical_address(F.col("source")),
    }
    if producer:
        columns["producer"] = identity.canonical_did(F.col("producer"))
    return df.withColumns(columns)


def default_id(payload_key: Column) -> Column:
    """One id per payload, shared by its headers and equal when replayed. ``payload_key``
    is the text of the message, so different messages get different ids."""
    return F.substring(F.sha2(payload_key.cast("string"), 256), 1, 27)


def message_text(events: DataFrame) -> Column:
    """The whole message where it is still there, else all that was parsed from it."""
    if "value" in events.columns:
        return F.col("value")
    parsed = [n for n in [*HEADER_NAMES, "data", "data_base64"] if n in events.columns]
    return F.to_json(F.struct(*parsed))


def judged(payloads: DataFrame) -> DataFrame:
    """Payloads with complete headers and the reason of their first bad one; a reason that
    is there already goes first.

    Input: ``payload_id, source, headers array<header>, data, body, ingest_time``. Every
    header is checked inside the array, so one bad header rejects the whole payload without
    grouping rows again."""
    no_base64 = F.lit(False)
    shared_id = default_id(F.col("payload_id"))

    def complete(h: Column) -> Column:
        filled = defaulted(lambda n: h[n], F.col("source"), shared_id, F.col("ingest_time"), no_base64)
        return F.struct(*[c.alias(n) for n, c in filled.items()])

    def fault(h: Column) -> Column:
        return connection_fault({n: h[n] for n in HEADER_NAMES}, no_base64)

    filled = payloads.withColumn("headers", F.transform("headers", complete))
    found = F.when(F.coalesce(F.size("headers"), F.lit(0)) <= 0, F.lit("no_headers")).otherwise(
        F.get(F.filter(F.transform("headers", fault), lambda r: r.isNotNull()), F.lit(0))
    )
    earlier = [F.col("reject_reason")] if "reject_reason" in payloads.columns else []
    return filled.withColumn("reject_reason", F.coalesce(*earlier, found))


def exploded(judged: DataFrame, *kept: str) -> DataFrame:
    """One event per header of judged payloads; what is rejected is one row without a header."""
    own = F.when(F.col("reject_reason").isNull(), F.col("headers"))
    events = (
        judged.withColumns({"data": _filled(F.col("data"), F.col("body")), "headers": own})
        .drop("source")
        .select("payload_id", "data", "ingest_time", *kept, F.posexplode_outer("headers").alias("header_index", "_h"))
        .select("payload_id", "header_index", "data", "ingest_time", "_h.*", *kept)
        .withColumn("is_future", checks.is_future(F.col("time"), F.col("ingest_time")))
    )
    return canonical_columns(events)


def fan_out(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One payload row to one event per header: (events, rejected payloads)."""
    checked = judged(payloads)
    return exploded(checked.where("reject_reason IS NULL")), checked.where("reject_reason IS NOT NULL")


def validate_connection(events: DataFrame, canonical: bool = True) -> DataFrame:
    """Already parsed single-header events: defaults, rules and ``reject_reason``."""
    no_base64 = F.lit(False)
    filled = defaulted(F.col, F.col("source"), default_id(message_text(events)), F.col("ingest_time"), no_base64)
    checked = events.withColumns(filled)
    fault = connection_fault({n: F.col(n) for n in HEADER_NAMES}, no_base64)
    earlier = [F.col("reject_reason")] if "reject_reason" in events.columns else []
    checked = checked.withColumns(
        {
            "is_future": checks.is_future(F.col("time"), F.col("ingest_time")),
            "reject_reason": F.coalesce(*earlier, fault),
        }
    )
    if not canonical:
        return checked
    # A rejected row keeps what it was sent with.
    made = canonical_columns(checked.withColumns({f"_sent_{n}": F.col(n) for n in _SENT}))
    accepted = F.col("reject_reason").isNull()
    kept = {n: F.when(accepted, F.col(n)).otherwise(F.col(f"_sent_{n}")) for n in _SENT}
    return made.withColumns(kept).drop(*[f"_sent_{n}" for n in _SENT])


_SENT = ["subject", "producer", "source"]


def reject_whole_payload(rows: DataFrame, payload: str, order: str, reason: str) -> DataFrame:
    """Long-form variant of the payload rule: the first fault of a payload becomes
    the reason of all its rows. Faults are reduced before the join, which keeps the
    right side unique; adaptive execution splits a hot payload on the left."""
    faults = (
        rows.where(F.col(reason).isNotNull())
        .groupBy(payload)
        .agg(F.min_by(reason, order).alias("_fault"))
    )
    return rows.join(faults, payload, "left").withColumn(reason, F.col("_fault")).drop("_fault")


def fingerprint_gate(enabled: bool = True) -> Column:
    """Event-level outcome of a fingerprint: NULL passes, ``dropped_vin`` is a silent
    drop and ``invalid_payload`` an error; other event types always pass."""
    if not enabled:
        return F.lit(None).cast("string")
    parsed = F.try_parse_json(F.col("data"))
    vin = F.try_variant_get(parsed, "$.vin", "string")
    return F.when(
        F.col("type") == fv.TYPE_FINGERPRINT,
        F.when(parsed.isNull(), F.lit("invalid_payload")).when(
            ~checks.vin_ok(F.coalesce(vin, F.lit(""))), F.lit("dropped_vin")
        ),
    )


def to_raw_row(events: DataFrame) -> DataFrame:
    """The 13 table columns of a stored event, plus any bookkeeping columns it has."""
    own = F.to_json(
        F.struct(
            F.when(F.size("tags") > 0, F.col("tags")).alias("tags"),
            F.when(~checks.is_blank(F.col("dataschema")), F.col("dataschema")).alias("dataschema"),
            F.when(~checks.is_blank(F.col("signature")), F.col("signature")).alias("signature"),
        )
    )
    has_base64 = ~checks.is_blank(F.col("data_base64"))
    row = {
        "subject": F.col("subject"),
        "time": F.date_trunc("millisecond", F.col("time")),
        "type": F.col("type"),
        "id": F.col("id"),
        "source": F.col("source"),
        "producer": F.col("producer"),
        "data_content_type": F.col("datacontenttype"),
        "data_version": F.col("dataversion"),
        "extras": merge_json_objects(own, F.coalesce("extras", F.lit("{}"))),
        "data": F.when(~has_base64 & ~checks.is_blank(F.col("data")), F.col("data")),
        "data_base64": F.when(has_base64, F.encode("data_base64", "UTF-8")),
        "data_index_key": F.when(~checks.is_blank(F.col("data_index_key")), F.col("data_index_key")),
        "voids_id": F.when(~checks.is_blank(F.col("voids_id")), F.col("voids_id")),
    }
    extra = [n for n in ("snapshot_id", "ingest_time") if n in events.columns]
    return events.select(*[c.alias(n) for n, c in row.items()], *extra)


def poison_fault(c: str = "data") -> Column:
    """Rows the table cannot hold, set aside before a write."""
    text = F.col(c)
    missing = F.col("time").isNull() | checks.is_blank(F.col("type"))
    return F.when(text.isNotNull() & ~F.is_valid_utf8(text), F.lit("invalid_utf8")).when(
        missing, F.lit("unserializable_header")
    )
