"""Size text, path and JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_POWERS = {"": 0, "b": 0, "k": 1, "m": 2, "g": 3, "t": 4}


def parse_size(c: Column) -> Column:
    """Bytes of "512MB", "1.5GB", "2GiB" or a bare number; 0 for anything else."""
    pattern = r"^\s*([0-9]+(?:\.[0-9]*)?|\.[0-9]+)\s*(?:([kmgt])i?b|b)?\s*\z"
    lowered = F.lower(c)
    number = F.regexp_extract(lowered, pattern, 1)
    unit = F.regexp_extract(lowered, pattern, 2)
    scale = F.lit(1.0)
    for letter, power in _UNIT_POWERS.items():
        if power:
            scale = F.when(unit == letter, F.lit(float(1024**power))).otherwise(scale)
    size = F.floor(number.try_cast("double") * scale).cast("long")
    return F.when(number != "", F.coalesce(size, F.lit(0))).otherwise(F.lit(0)).cast("long")


def path_prefix(c: Column) -> Column:
    """Everything up to and including the last slash."""
    return F.regexp_extract(c, r"^(.*/)?[^/]*\z", 1)


def storage_path(c: Column) -> Column:
    """The path a file system understands, from the URL-encoded form that the file
    metadata column reports. Local paths get one slash after the scheme."""
    decoded = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return one_slash(decoded)


def one_slash(c: Column) -> Column:
    return F.regexp_replace(c, "^file:/+", "file:/")


def merge_json_objects(a: Column, b: Column) -> Column:
    """Join two serialised JSON objects that share no keys."""
    joined = F.concat(F.lit("{"), _inner(a), F.lit(","), _inner(b), F.lit("}"))
    return F.when(a == "{}", b).when(b == "{}", a).otherwise(joined)


def _inner(c: Column) -> Column:
    return F.substring(c, F.lit(2), F.length(c) - 2)
