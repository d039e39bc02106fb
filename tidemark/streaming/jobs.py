"""Structured Streaming jobs: raw ingest and decode."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed_values as fv
from tidemark.functions import checks, identity
from tidemark.operators import decode, normalize, payloads
from tidemark.operators.attest import normalize_attestations
from tidemark.operators.dedup import keep_latest
from tidemark.plans.lake import RawEventTable, append_decoded, quarantine
from tidemark.sources.envelopes import parse_envelopes, split_rejects
from tidemark.streaming.batches import start_named, state_on_disk
from tidemark.streaming.bundles import Bounds, Bundles, FlushWhenIdle
from tidemark.streaming.consume import consume


ORIGINS = (CONNECTION, ATTESTATION, PAYLOAD) = ("connection", "attestation", "payload")


def parsed(messages: DataFrame) -> DataFrame:
    """Parse messages; ``headers`` may say the ``origin`` (by default a connection), the
    authenticated ``caller`` and, for attestations, whether the signature holds."""
    header = lambda name: F.element_at(F.col("headers"), name)
    out = parse_envelopes(messages).withColumns(
        {
            "origin": F.coalesce(header("origin"), F.lit(CONNECTION)),
            "caller": header("caller"),
            "signature_valid": F.coalesce(header("signature-valid") == "true", F.lit(False)),
        }
    )
    unknown = F.when(~F.col("origin").isin(*ORIGINS), F.lit("unknown_origin"))
    return out.withColumn("reject_reason", F.coalesce("reject_reason", unknown))


def dedup_arrivals(events: DataFrame, window: str = "2 minutes") -> DataFrame:
    """First arrival of each message inside the arrival window.

    A message that brings its whole event key is known by it. One that leaves a part to its
    defaults is known by its text and caller: two of these are not one event because they
    agree in the parts they have.

    The window runs on the time at which a micro-batch takes the row, which never goes
    back, so no row is ever late: old events, slow partitions and backlogs all pass. Copies
    outside the window are left to the reader (``dedup_latest``).
    """
    whole_text = F.concat_ws("|", F.sha2(F.coalesce("value", F.lit("")), 256), "caller")
    texts = [~checks.is_blank(F.col(c)) for c in identity.KEY_FIELDS if c != "time"]
    whole_key = reduce(and_, texts, F.col("time").isNotNull())
    own_id = F.when(F.col("reject_reason").isNull() & (F.col("origin") != PAYLOAD) & whole_key, identity.message_id())
    keyed = events.withColumns(
        {"_message_id": F.concat_ws("|", "origin", F.coalesce(own_id, whole_text)), "_taken": F.current_timestamp()}
    )
    once = keyed.withWatermark("_taken", window).dropDuplicatesWithinWatermark(["_message_id"])
    return once.drop("_message_id", "_taken")


def normalized(events: DataFrame) -> DataFrame:
    """Parsed messages of every origin to events; rejected rows carry ``reject_reason``.

    A payload message has an array of headers and becomes one event each, or is rejected
    whole; the other origins are one event each."""
    connection = normalize.validate_connection(events.where(F.col("origin").isNull() | ~F.col("origin").isin(ATTESTATION, PAYLOAD)))
    attested = normalize_attestations(events.where(F.col("origin") == ATTESTATION))
    array = F.from_json("value", f"headers array<{normalize.HEADER}>")["headers"]
    payloads_in = events.where(F.col("origin") == PAYLOAD).withColumn("source", F.col("caller"))
    # A payload takes itself along, so that a rejected one is set aside as it came, and all of
    # them are read and judged once.
    sent = F.struct(*events.columns).alias("_sent")
    own = [F.sha2("value", 256).alias("payload_id"), array.alias("headers"), F.col("value").alias("body"), sent]
    judged = normalize.judged(payloads_in.select("source", "data", "ingest_time", "reject_reason", *own))
    fanned = normalize.exploded(judged, "reject_reason", "_sent").withColumn("origin", F.lit(PAYLOAD))
    aside = F.col("reject_reason").isNotNull()
    made = [c for c in fanned.columns if c not in ("reject_reason", "_sent")]
    back = [c for c in events.columns if c != "reject_reason"]
    either = {c: F.when(aside, F.col(f"_sent.{c}")) if c in back else F.when(~aside, F.col(c)) for c in dict.fromkeys(made + back)}
    either |= {c: F.when(aside, F.col(f"_sent.{c}")).otherwise(F.col(c)) for c in made if c in back}
    fanned = fanned.select(*[v.alias(c) for c, v in either.items()], "reject_reason")
    every = connection.unionByName(attested, allowMissingColumns=True)
    every = every.unionByName(fanned, allowMissingColumns=True)
    gate = F.coalesce("reject_reason", normalize.fingerprint_gate(), normalize.poison_fault())
    return every.withColumn("reject_reason", gate)


def ingest_query(
    messages: DataFrame,
    table: RawEventTable,
    checkpoint: str,
    query: str = "ingest",
    threshold: int = fv.SPLIT_THRESHOLD_BYTES,
    trigger: dict | None = None,
    dedup_window: str | None = "2 minutes",
    bounds: Bounds | None = None,
    **write_options: str,
) -> StreamingQuery:
    """Messages of all origins to blobs, raw rows, quarantine and counts of outcomes.

    Every micro-batch owns one folder of each, named by the checkpoint's id and the batch
    number: written again it replaces itself, and a new checkpoint never meets old names.
    Accepted and rejected rows together are all rows of the batch. The table is written last
    and its commit ends the batch; a batch that is committed is not touched again.

    With ``bounds`` small batches wait for each other and are committed as bundles.
    """
    bundles = Bundles(table, bounds, **write_options) if bounds else None
    if bundles:
        table.spark.streams.addListener(FlushWhenIdle(bundles, query))
    arrivals = parsed(messages)
    if dedup_window:
        arrivals = dedup_arrivals(arrivals, dedup_window)

    def write(batch: DataFrame, name: str) -> None:
        if table.snapshot_of(name if not bundles else f"staged-{name}") is not None:
            # Nothing to write; the state of the deduplication moves on with the batch.
            batch.write.format("noop").mode("overwrite").save()
            return
        # The batch is taken from the stream once, and its events are made once.
        batch = batch.persist()
        events = normalized(batch).persist()
        try:
            accepted, rejected = split_rejects(events)
            stored, blobs, faults = payloads.split_payloads(accepted, threshold)
            blobs.write.mode("overwrite").parquet(f"{table.root}/blobs/batch={name}")
            both = rejected.unionByName(faults, allowMissingColumns=True)
            quarantine(both, f"{table.root}/quarantine/batch={name}", "overwrite")
            outcomes = outcome_rows(stored, both)
            outcomes.write.mode("overwrite").parquet(f"{table.root}/outcomes/batch={name}")
            rows = normalize.to_raw_row(stored)
            if bundles:
                if not rows.isEmpty():
                    bundles.stage(rows.withColumn("ingest_time", F.lit(_now())), name)
                bundles.flush(_now())
            else:
                table.write(rows, name, _now(), **write_options)
        finally:
            events.unpersist()
            batch.unpersist()

    # The keys of the arrival window grow with the rate of messages.
    with state_on_disk(table.spark):
        return start_named(arrivals, write, checkpoint, query, trigger)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def outcome_rows(stored: DataFrame, rejected: DataFrame) -> DataFrame:
    """(origin, outcome, events): what became of the events of a micro-batch."""
    taken = stored.select("origin", F.lit("accepted").alias("outcome"))
    return taken.unionByName(rejected.select("origin", F.col("reject_reason").alias("outcome"))).groupBy("origin", "outcome").agg(
        F.count(F.lit(1)).alias("events")
    )


def outcome_counts(table: RawEventTable) -> DataFrame:
    """(origin, outcome, events) over all micro-batches so far. Each batch has written its
    own counts, so a repeated batch or a restart counts nothing twice."""
    rows = table.spark.read.schema("origin string, outcome string, events long, batch string").parquet(f"{table.root}/outcomes")
    return rows.groupBy("origin", "outcome").agg(F.sum("events").alias("events"))


def blobs_of(table: RawEventTable) -> DataFrame:
    return table.spark.read.schema("data_index_key string, payload binary, batch string").parquet(f"{table.root}/blobs")


def write_lanes(packed: DataFrame, target: str, batch: str) -> None:
    """One lane per name token, below it one folder per event date."""
    dated = packed.withColumn("event_date", F.to_date("header.time"))
    append_decoded(dated, target, batch, ["dedup_id"], "event_date", ("name_token",))


def read_lanes(spark: SparkSession, target: str) -> DataFrame:
    """Decoded rows of all batches, each id once."""
    return keep_latest(spark.read.parquet(target), ["dedup_id"], ["batch"])


def decode_query(
    raw_rows: DataFrame,
    target: str,
    checkpoint: str,
    chain: int | str,
    contract: str,
    query: str = "decode",
    trigger: dict | None = None,
    errors: str | None = None,
) -> StreamingQuery:
    """Raw rows to packed signals, one lane per name token. What could not be decoded goes
    to ``errors`` (by default beside the target), one row per event and reason."""

    return start_named(raw_rows, _decoder(target, chain, contract, errors), checkpoint, query, trigger)


def decode_table(
    table: RawEventTable,
    target: str,
    checkpoint: str,
    chain: int | str,
    contract: str,
    consumer: str = "decode",
    trigger: dict | None = None,
    errors: str | None = None,
    max_commits: int = 100,
) -> StreamingQuery:
    """The same over every commit of the table, with a cursor."""
    return consume(table, consumer, _decoder(target, chain, contract, errors), checkpoint, max_commits, trigger)


def _decoder(target: str, chain: int | str, contract: str, errors: str | None):
    aside = errors or target.rstrip("/") + "-errors"

    def write(batch: DataFrame, name: str) -> None:
        # Lanes and faults are two outputs of one decoding.
        decoded = decode.decoded_events(batch, chain, contract, F.col("ingest_time")).persist()
        try:
            write_lanes(decode.packed_of(decoded), target, name)
            decode.faults_of(decoded).write.mode("overwrite").parquet(f"{aside}/batch={name}")
        finally:
            decoded.unpersist()

    return write


def decode_events_query(
    raw_rows: DataFrame, target: str, checkpoint: str, query: str = "decode_events", trigger: dict | None = None
) -> StreamingQuery:
    """The same for vehicle events."""

    def write(batch: DataFrame, name: str) -> None:
        write_lanes(decode.decode_packed_events(batch), target, name)

    return start_named(raw_rows, write, checkpoint, query, trigger)
