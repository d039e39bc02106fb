"""Validation predicates as column expressions. Each returns a non-null boolean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv

# Java's ``$`` also matches before a trailing newline, so anchors use \z.
IDENTIFIER = r"^[a-zA-Z0-9_/,. :-]+\z"
ADDRESS = r"^(0[xX])?[0-9a-fA-F]{40}\z"
ERC721 = r"^did:erc721:([0-9]+):((?:0[xX])?[0-9a-fA-F]{40}):([0-9]+)\z"
LEGACY_NFT = r"^did:nft:([0-9]+):((?:0[xX])?[0-9a-fA-F]{40})_([0-9]+)\z"
ETHR = r"^did:ethr:([0-9]+):((?:0[xX])?[0-9a-fA-F]{40})\z"
VIN = r"^[A-HJ-NPR-Z0-9]{17}\z"
JAPAN_CHASSIS = r"^[A-Z0-9]{2,6}-[0-9]{4,7}\z"


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def valid_identifier(c: Column) -> Column:
    return _matches(c, IDENTIFIER)


def valid_optional_identifier(c: Column) -> Column:
    return is_blank(c) | valid_identifier(c)


def address_ok(c: Column) -> Column:
    return _matches(c, ADDRESS)


def device_did_ok(c: Column) -> Column:
    return _matches(c, ERC721) | _matches(c, LEGACY_NFT)


def attestation_did_ok(c: Column) -> Column:
    return _matches(c, ERC721) | _matches(c, ETHR)


def connection_type_ok(c: Column) -> Column:
    return F.coalesce(c.isin(*fv.CONNECTION_TYPES), F.lit(False))


def attestation_type_ok(c: Column) -> Column:
    ok = c.isin(fv.TYPE_ATTESTATION, fv.TYPE_TOMBSTONE)
    for prefix in fv.ATTESTATION_PREFIXES:
        ok = ok | (c.startswith(prefix) & (F.length(c) > len(prefix)))
    return F.coalesce(ok, F.lit(False))


def is_future(time: Column, as_of: Column, skew_seconds: int = fv.ALLOWED_SKEW_SECONDS) -> Column:
    """Strictly later than ``as_of`` plus the allowed skew."""
    return F.coalesce(time > as_of + F.make_dt_interval(secs=F.lit(skew_seconds)), F.lit(False))


def content_type_fault(content_type: Column, is_base64: Column) -> Column:
    """NULL when the (already defaulted) content type is acceptable."""
    return (
        F.when(is_base64 & is_blank(content_type), F.lit("missing_content_type"))
        .when(~is_base64 & (content_type != fv.DEFAULT_CONTENT_TYPE), F.lit("content_type_not_json"))
        .when(
            ~F.coalesce(content_type.isin(*fv.CONTENT_TYPES), F.lit(False)),
            F.lit("content_type_not_allowed"),
        )
    )


def vin_ok(c: Column) -> Column:
    return _matches(c, VIN) | _matches(c, JAPAN_CHASSIS)


def valid_lat_lon(lat: Column, lon: Column) -> Column:
    """Finite, inside WGS-84 bounds and not the (0, 0) no-fix position."""
    inside = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    null_island = (lat == 0) & (lon == 0)
    return F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & inside & ~null_island, F.lit(False))


def payload_length(data: Column, data_base64: Column) -> Column:
    """Payload bytes; for base64 text the upper bound ``floor(len / 4) * 3``."""
    encoded = F.floor(F.length(data_base64) / 4) * 3
    return F.when(~is_blank(data_base64), encoded).otherwise(F.coalesce(F.octet_length(data), F.lit(0)))


def needs_split(
    data: Column, data_base64: Column, threshold: int = fv.SPLIT_THRESHOLD_BYTES
) -> Column:
    return payload_length(data, data_base64) > threshold


def valid_base64(c: Column) -> Column:
    return F.try_to_binary(c, F.lit("base64")).isNotNull()
