"""Payload sealing: magic, 12-byte nonce, ciphertext and tag (AES-256-GCM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv

_MAGIC = fv.SEAL_MAGIC.encode("ascii")


def _key(key_base64: str) -> Column:
    return F.unbase64(F.lit(key_base64))


def is_sealed(blob: Column) -> Column:
    return F.coalesce(F.substring(blob, 1, len(_MAGIC)) == F.lit(_MAGIC), F.lit(False))


def seal(payload: Column, key_base64: str, aad: Column) -> Column:
    """Seal ``payload`` bound to its object key ``aad``; NULL stays NULL."""
    body = F.aes_encrypt(payload, _key(key_base64), F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), aad)
    return F.concat(F.lit(_MAGIC), body)


def open_sealed(blob: Column, key_base64: str, aad: Column) -> Column:
    """Plaintext; an unsealed blob passes through, a wrong key, key path or tampered
    blob gives NULL (see ``open_failed``)."""
    body = F.substring(blob, F.lit(len(_MAGIC) + 1), F.octet_length(blob) - len(_MAGIC))
    opened = F.try_aes_decrypt(body, _key(key_base64), F.lit("GCM"), F.lit("DEFAULT"), aad)
    return F.when(is_sealed(blob), opened).otherwise(blob)


def open_failed(blob: Column, opened: Column) -> Column:
    return blob.isNotNull() & opened.isNull()
