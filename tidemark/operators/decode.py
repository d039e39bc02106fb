"""Raw events to signals. One raw row already holds all signals of its event, so
decode, prune, coordinate merge and packing are array expressions without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import checks, identity
from tidemark.operators.dedup import keep_latest

_ELEMENTS = "struct<signals:array<struct<name:string,timestamp:string,value:string>>>"
_TYPED = "array<struct<timestamp:timestamp,name:string,pos:int,value:double>>"
_LOCATION = "struct<lat:double,lon:double,hdop:double>"

_decoders: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_decoder(source: str, decoder: Callable[[DataFrame], DataFrame]) -> None:
    """Use ``decoder`` for one source address. It receives raw rows and returns them
    with ``signals`` and ``decode_errors`` arrays (see ``decode_default``)."""
    _decoders[source] = decoder


def unregister_decoder(source: str) -> None:
    _decoders.pop(source, None)


# A parser of one payload text: elements as (name, timestamp text, value text).
Parser = Callable[[str], Iterable[tuple[str | None, str | None, str | None]]]

_parsers: dict[str, Parser] = {}


def register_parser(source: str, parser: Parser) -> None:
    """Use a Python parser for one source address. All parsers are served by one pass over
    the rows, whatever their number; what they return is judged like the default payload. A
    parser that fails makes the payload one of no elements and one error."""
    _parsers[source] = parser


def unregister_parser(source: str) -> None:
    _parsers.pop(source, None)


def inline_rows(df: DataFrame, array: str, *keep: Column | str) -> DataFrame:
    """One row per array element; an element of all NULLs does not count as one.

    The outer form is used because the plain one makes the optimizer push a size filter
    below the array expressions and evaluate them twice. Empty arrays are dropped by
    looking at generated columns only, which cannot be pushed down either.
    """
    fields = df.schema[array].dataType.elementType.fieldNames()
    rows = df.select(*keep, F.inline_outer(array).alias(*fields))
    return rows.where(" OR ".join(f"`{name}` IS NOT NULL" for name in fields))


def parse_elements(source: Column, data: Column, parsers: dict[str, Parser]) -> Column:
    """struct(signals, failed) of the payloads whose source has a parser, else NULL: one
    Arrow UDF that picks the parser row by row."""

    @F.pandas_udf(f"{_ELEMENTS[:-1]},failed:boolean>")
    def parse(sources: pd.Series, payloads: pd.Series) -> pd.DataFrame:
        found, failed = [], []
        for key, text in zip(sources, payloads):
            try:
                elements = [dict(zip(("name", "timestamp", "value"), e)) for e in parsers[key](text)] if text is not None else []
                found.append(elements)
                failed.append(False)
            except Exception:  # noqa: BLE001 - a vendor's parser may raise anything
                found.append([])
                failed.append(True)
        return pd.DataFrame({"signals": found, "failed": failed})

    known = source.isin(*parsers)
    return F.when(known, parse(F.when(known, source), F.when(known, data)))


def decode_default(raw: DataFrame, parsers: dict[str, Parser] | None = None) -> DataFrame:
    """Add ``signals`` (good elements) and ``decode_errors`` (reasons of the others)."""

    def typed(x: Column, i: Column) -> Column:
        return F.struct(
            x["timestamp"].try_cast("timestamp").alias("timestamp"),
            x["name"].alias("name"),
            i.alias("pos"),
            x["value"].try_cast("double").alias("value"),
        )

    def fault(t: Column) -> Column:
        return (
            F.when(checks.is_blank(t["name"]), F.lit("missing_name"))
            .when(t["timestamp"].isNull(), F.lit("bad_timestamp"))
            .when(t["value"].isNull(), F.lit("bad_value"))
        )

    def good(t: Column) -> Column:
        return (t["name"] != "") & t["timestamp"].isNotNull() & t["value"].isNotNull()

    elements = F.from_json("data", _ELEMENTS)["signals"]
    none = F.array().cast(_TYPED)
    faults = F.filter(F.transform("_t", fault), lambda r: r.isNotNull())
    if parsers:
        raw = raw.withColumn("_parsed", parse_elements(F.col("source"), F.col("data"), parsers))
        own = F.coalesce(F.col("source").isin(*parsers), F.lit(False))
        elements = F.when(own, F.col("_parsed.signals")).otherwise(elements)
        failed = F.coalesce(F.col("_parsed.failed"), F.lit(False))
        faults = F.when(failed, F.array(F.lit("parser_failed"))).otherwise(faults)
    return (
        raw.withColumn("_t", F.coalesce(F.transform(elements, typed), none))
        .withColumns({"signals": F.filter("_t", good), "decode_errors": faults})
        .drop("_t", "_parsed")
    )


def decode_arrays(raw: DataFrame, chain: int | str, contract: str) -> DataFrame:
    """Status events of vehicle subjects with their decoded arrays."""
    wanted = raw.where(
        (F.col("type") == fv.TYPE_STATUS)
        & identity.is_vehicle_subject(F.col("subject"), chain, contract)
    )
    if not _decoders:
        return decode_default(wanted, dict(_parsers))
    known = F.col("source").isin(*_decoders)
    out = decode_default(wanted.where(~F.coalesce(known, F.lit(False))), dict(_parsers))
    for source, decoder in _decoders.items():
        out = out.unionByName(decoder(wanted.where(F.col("source") == source)).select(*out.columns))
    return out


def decode_signals(raw: DataFrame, chain: int | str, contract: str) -> tuple[DataFrame, DataFrame]:
    """Long form: (signals, errors per raw event and reason position)."""
    decoded = decode_arrays(raw, chain, contract).withColumn("event_key", identity.event_key())
    signals = inline_rows(decoded, "signals", "event_key", "subject")
    errors = decoded.select("event_key", "subject", F.explode_outer("decode_errors").alias("reason"))
    errors = errors.where("reason IS NOT NULL")
    return signals, errors


def prune(ordered: Column, as_of: Column) -> Column:
    """Drop future signals; of equal (timestamp, name) neighbours keep the last.

    ``ordered`` is sorted by (timestamp, name, position).
    """

    def unless_repeated(x: Column, after: Column) -> Column:
        same = (after["timestamp"] == x["timestamp"]) & (after["name"] == x["name"])
        return F.when(F.coalesce(same, F.lit(False)), F.lit(None)).otherwise(x)

    # Zipping with the array shifted by one pads the last element with NULL.
    shifted = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0)))
    kept = F.zip_with(ordered, shifted, unless_repeated)
    return F.filter(kept, lambda x: x.isNotNull() & ~checks.is_future(x["timestamp"], as_of))


def with_pruned(decoded: DataFrame, as_of: Column) -> DataFrame:
    ordered = decoded.withColumn("signals", F.array_sort("signals"))
    return ordered.withColumn("signals", prune(F.col("signals"), as_of))


def prune_long(signals: DataFrame, as_of: Column, event: str = "event_key") -> DataFrame:
    """The same rule for exploded rows, as an aggregate per (event, name, timestamp)."""
    kept = keep_latest(signals, [event, "name", "timestamp"], ["pos"])
    return kept.where(~checks.is_future(F.col("timestamp"), as_of))


_PARTS = (fv.SIGNAL_LATITUDE, fv.SIGNAL_LONGITUDE, fv.SIGNAL_HDOP)
_LAT, _LON, _HDOP = 0, 1, 2


def _coordinate_fold(signals: Column) -> Column:
    """struct(created, errors) from signals in (timestamp, name) order.

    The open triple is held in the accumulator and closed when a signal is 500 ms or
    more after its first member, when a part arrives a second time, and at the end.
    Parts are reduced to (micros, kind, value) first, which keeps each step cheap.
    """
    kind = lambda x: F.when(x["name"] == _PARTS[_LAT], _LAT).when(x["name"] == _PARTS[_LON], _LON).otherwise(_HDOP)
    parts = F.transform(
        F.filter(signals, lambda x: x["name"].isin(*_PARTS)),
        lambda x: F.struct(F.unix_micros(x["timestamp"]).alias("us"), kind(x).alias("kind"), x["value"].alias("value")),
    )
    none = F.lit(None).cast("double")
    start = F.struct(
        none.alias("lat"),
        none.alias("lon"),
        none.alias("hdop"),
        F.lit(None).cast("long").alias("first"),
        F.array().cast(f"array<struct<us:bigint,location:{_LOCATION}>>").alias("created"),
        F.array().cast("array<string>").alias("errors"),
    )

    def closed(acc: Column) -> tuple[Column, Column]:
        pair = acc["lat"].isNotNull() & acc["lon"].isNotNull()
        usable = pair & checks.valid_lat_lon(acc["lat"], acc["lon"])
        location = F.struct(
            acc["lat"].alias("lat"), acc["lon"].alias("lon"), F.coalesce(acc["hdop"], F.lit(0.0)).alias("hdop")
        )
        made = F.array(F.struct(acc["first"].alias("us"), location.alias("location")))
        created = F.when(usable, F.concat(acc["created"], made)).otherwise(acc["created"])
        fault = (
            F.when(pair & ~usable, F.lit("invalid_coordinate"))
            .when(acc["lat"].isNotNull() & ~pair, F.lit("unpaired_latitude"))
            .when(acc["lon"].isNotNull() & ~pair, F.lit("unpaired_longitude"))
        )
        errors = F.when(fault.isNotNull(), F.concat(acc["errors"], F.array(fault))).otherwise(acc["errors"])
        return created, errors

    def step(acc: Column, x: Column) -> Column:
        held = F.when(x["kind"] == _LAT, acc["lat"]).when(x["kind"] == _LON, acc["lon"]).otherwise(acc["hdop"])
        late = x["us"] - acc["first"] >= fv.COORDINATE_WINDOW_MICROS
        close = acc["first"].isNotNull() & (late | held.isNotNull())
        created, errors = closed(acc)

        def part(field: str, kind: int) -> Column:
            return F.when(x["kind"] == kind, x["value"]).when(~close, acc[field]).alias(field)

        return F.struct(
            part("lat", _LAT),
            part("lon", _LON),
            part("hdop", _HDOP),
            F.when(close | acc["first"].isNull(), x["us"]).otherwise(acc["first"]).alias("first"),
            F.when(close, created).otherwise(acc["created"]).alias("created"),
            F.when(close, errors).otherwise(acc["errors"]).alias("errors"),
        )

    def finish(acc: Column) -> Column:
        created, errors = closed(acc)
        return F.struct(created.alias("created"), errors.alias("errors"))

    return F.aggregate(parts, start, step, finish)


def merge_coordinates(pruned: DataFrame) -> DataFrame:
    """Replace coordinate parts by location signals; adds ``location_errors``.

    After this step ``signals`` holds struct(name, timestamp, value, location).
    """
    shaped = F.transform(
        F.filter("signals", lambda x: ~x["name"].isin(*_PARTS)),
        lambda x: F.struct(
            x["name"].alias("name"),
            x["timestamp"].alias("timestamp"),
            x["value"].alias("value"),
            F.lit(None).cast(_LOCATION).alias("location"),
        ),
    )
    made = F.transform(
        F.col("_fold.created"),
        lambda c: F.struct(
            F.lit(fv.SIGNAL_LOCATION).alias("name"),
            F.timestamp_micros(c["us"]).alias("timestamp"),
            F.lit(None).cast("double").alias("value"),
            c["location"].alias("location"),
        ),
    )
    return (
        pruned.withColumn("_fold", _coordinate_fold(F.col("signals")))
        .withColumns({"signals": F.concat(shaped, made), "location_errors": F.col("_fold.errors")})
        .drop("_fold")
    )


def decoded_header(type: str) -> Column:
    """The raw event's header fields under a new event type."""
    kept = ["specversion", "subject", "source", "producer", "id", "time", "data_version"]
    return F.struct(*[F.col(n) for n in kept], F.lit(type).alias("type"))


def pack_by_name(decoded: DataFrame, array: str = "signals") -> DataFrame:
    """One row per (raw event, name) holding that name's elements in time order."""
    names = F.array_distinct(F.transform(F.col(array), lambda x: x["name"]))
    groups = F.transform(
        names,
        lambda n: F.struct(
            n.alias("name"),
            F.array_sort(
                F.filter(F.col(array), lambda x: x["name"] == n),
                lambda a, b: F.when(a["timestamp"] < b["timestamp"], -1)
                .when(a["timestamp"] > b["timestamp"], 1)
                .otherwise(0),
            ).alias(array),
        ),
    )
    rest = [c for c in decoded.columns if c != array]
    return inline_rows(decoded.withColumn("_groups", groups), "_groups", *rest)


def pack_long(signals: DataFrame, event: str = "event_key") -> DataFrame:
    """Packing for rows that are already exploded and pruned to unique
    (event, name, timestamp): the list is then bounded by one event's payload."""
    return signals.groupBy(event, "name").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", "value"))).alias("signals")
    )


def unpack(packed: DataFrame, array: str = "signals") -> DataFrame:
    """Inverse of packing."""
    rest = [c for c in packed.columns if c not in (array, "name")]
    return inline_rows(packed, array, *rest)


def decoded_events(raw: DataFrame, chain: int | str, contract: str, as_of: Column) -> DataFrame:
    """Status events with their pruned and merged ``signals`` and what decoding leaves out
    (``decode_errors``, ``_ahead``, ``location_errors``). Both outputs follow from it."""
    decoded = decode_arrays(raw.withColumn("event_key", identity.event_key()), chain, contract)
    ahead = F.transform(
        F.filter("signals", lambda x: checks.is_future(x["timestamp"], as_of)),
        lambda x: F.concat(F.lit("future_signal: "), x["name"]),
    )
    return merge_coordinates(with_pruned(decoded.withColumn("_ahead", ahead), as_of))


def packed_of(decoded: DataFrame) -> DataFrame:
    """Decoded events packed by name, with replay-safe ids."""
    if "specversion" not in decoded.columns:
        decoded = decoded.withColumn("specversion", F.lit(fv.DEFAULT_SPEC_VERSION))
    packed = pack_by_name(decoded)
    return packed.select(
        identity.decoded_id(F.col("event_key"), F.col("name")).alias("dedup_id"),
        "event_key",
        "name",
        identity.name_token(F.col("name")).alias("name_token"),
        decoded_header(fv.TYPE_SIGNALS).alias("header"),
        "signals",
    )


def faults_of(decoded: DataFrame) -> DataFrame:
    """What decoding leaves out, one row per raw event, reason and position: elements that
    cannot be decoded, signals from the future, and coordinates without a partner."""
    places = F.transform(F.col("location_errors"), lambda e: F.concat(F.lit("location: "), e.cast("string")))
    every = F.concat("decode_errors", "_ahead", places)
    return decoded.select("event_key", "subject", F.posexplode(every).alias("position", "reason"))


def decode_packed(raw: DataFrame, chain: int | str, contract: str, as_of: Column) -> DataFrame:
    """Decode, prune, merge coordinates and pack, with replay-safe ids."""
    return packed_of(decoded_events(raw, chain, contract, as_of))


def decode_faults(raw: DataFrame, chain: int | str, contract: str, as_of: Column) -> DataFrame:
    return faults_of(decoded_events(raw, chain, contract, as_of))


def decode_vehicle_events(raw: DataFrame) -> DataFrame:
    """Events-type messages, any subject: one array element per event, with errors."""
    wanted = raw.where(F.col("type") == fv.TYPE_EVENTS)
    elements = F.from_json("data", "struct<events:array<string>>")["events"]
    typed = F.transform(
        elements,
        lambda e: F.struct(
            F.get_json_object(e, "$.name").alias("name"),
            F.get_json_object(e, "$.timestamp").try_cast("timestamp").alias("timestamp"),
            e.alias("payload"),
        ),
    )
    good = lambda x: ~checks.is_blank(x["name"]) & x["timestamp"].isNotNull()
    empty = F.array().cast("array<struct<name:string,timestamp:timestamp,payload:string>>")
    return (
        wanted.withColumn("_e", F.coalesce(typed, empty))
        .withColumns(
            {
                "events": F.filter("_e", good),
                "decode_errors": F.size(F.filter("_e", lambda x: ~good(x))),
            }
        )
        .drop("_e")
    )


def decode_packed_events(raw: DataFrame) -> DataFrame:
    """Vehicle events packed per name, with the same id scheme as signals."""
    decoded = decode_vehicle_events(raw.withColumn("event_key", identity.event_key()))
    if "specversion" not in decoded.columns:
        decoded = decoded.withColumn("specversion", F.lit(fv.DEFAULT_SPEC_VERSION))
    packed = pack_by_name(decoded, "events")
    return packed.select(
        identity.decoded_id(F.col("event_key"), F.col("name")).alias("dedup_id"),
        "event_key",
        "name",
        identity.name_token(F.col("name")).alias("name_token"),
        decoded_header(fv.TYPE_EVENTS).alias("header"),
        "events",
    )


def latest_signals(signals: DataFrame) -> DataFrame:
    """Newest value per (subject, name); ties fall to the greatest remaining columns."""
    return keep_latest(signals, ["subject", "name"], ["timestamp"])
