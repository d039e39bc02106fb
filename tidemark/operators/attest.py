"""Attestations and tombstones. The signature outcome is an input column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import checks
from tidemark.operators.normalize import HEADER_NAMES, canonical_columns, default_id, defaulted, header_fault


def parse_tombstone(data: Column) -> tuple[Column, Column]:
    """(voids_id, fault): the id is NULL whenever a fault is set."""
    parsed = F.try_parse_json(data)
    shape = F.schema_of_variant(parsed)
    is_object = F.coalesce(shape.startswith("OBJECT"), F.lit(False))
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$.voidsId", "variant"))
    reason_kind = F.schema_of_variant(F.try_variant_get(parsed, "$.reason", "variant"))
    textual = lambda k: F.coalesce(k.isin("STRING", "VOID"), F.lit(True))
    voids = F.coalesce(F.try_variant_get(parsed, "$.voidsId", "string"), F.lit(""))
    reason = F.coalesce(F.try_variant_get(parsed, "$.reason", "string"), F.lit(""))
    fault = (
        F.when(checks.is_blank(data), F.lit("tombstone_data_required"))
        .when(~is_object | ~textual(kind) | ~textual(reason_kind), F.lit("tombstone_not_an_object"))
        .when(voids == "", F.lit("tombstone_voids_id_required"))
        .when(~checks.valid_identifier(voids), F.lit("tombstone_invalid_voids_id"))
        .when(F.octet_length(reason) > fv.MAX_REASON_BYTES, F.lit("tombstone_reason_too_long"))
    )
    return F.when(fault.isNull(), voids), fault


def normalize_attestations(
    events: DataFrame, caller: str = "caller", signature_valid: str = "signature_valid"
) -> DataFrame:
    """Validate parsed attestations; adds ``voids_id`` and ``reject_reason``.

    A source inside the payload wins over the caller's address (delegation).
    """
    is_base64 = ~checks.is_blank(F.col("data_base64"))
    source = F.when(checks.is_blank(F.col("source")), F.col(caller)).otherwise(F.col("source"))
    early = (
        F.when(checks.is_future(F.col("time"), F.col("ingest_time")), F.lit("future_time"))
        .when(~checks.attestation_did_ok(F.col("subject")), F.lit("invalid_subject"))
        .when(~checks.address_ok(source), F.lit("invalid_source"))
    )
    earlier = [F.col("reject_reason")] if "reject_reason" in events.columns else []
    checked = events.withColumn("_early", F.coalesce(*earlier, early))
    id_seed = F.concat_ws("|", "subject", "source", "data", "data_base64", F.col("ingest_time").cast("string"))
    checked = checked.withColumns(
        defaulted(F.col, source, default_id(id_seed), F.col("ingest_time"), is_base64)
    )
    fault = header_fault({n: F.col(n) for n in HEADER_NAMES}, is_base64)
    checked = checked.withColumn("_early", F.coalesce("_early", fault))
    checked = checked.withColumn(
        "type", F.when(checks.is_blank(F.col("type")), F.lit(fv.TYPE_ATTESTATION)).otherwise(F.col("type"))
    )
    is_tombstone = F.col("type") == fv.TYPE_TOMBSTONE
    voids_id, tombstone_fault = parse_tombstone(F.col("data"))
    reason = F.coalesce(
        F.col("_early"),
        F.when(~checks.attestation_type_ok(F.col("type")), F.lit("unsupported_type")),
        F.when(~F.coalesce(F.col(signature_valid), F.lit(False)), F.lit("invalid_signature")),
        F.when(is_tombstone, tombstone_fault),
    )
    checked = checked.withColumns(
        {
            "reject_reason": reason,
            "voids_id": F.when(is_tombstone & reason.isNull(), voids_id),
            "_subject": F.col("subject"),
            "_source": F.col("source"),
        }
    )
    made = canonical_columns(checked, ethr=True, producer=False)
    return made.withColumns(
        {
            "subject": F.coalesce("subject", "_subject"),
            "source": F.coalesce("source", "_source"),
        }
    ).drop("_early", "_subject", "_source")
