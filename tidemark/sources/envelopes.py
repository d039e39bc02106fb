"""Wire messages to typed events; malformed input becomes a reject, never a failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv

# Top-level message fields that have a column of their own.
HEADER_FIELDS = [
    "specversion",
    "type",
    "subject",
    "source",
    "producer",
    "id",
    "datacontenttype",
    "dataschema",
    "dataversion",
    "signature",
]
NAMED_FIELDS = HEADER_FIELDS + ["time", "tags", "data", "data_base64"]

RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\z"


# Numbers outside strings are marked before the parse and unmarked after it, as the parser
# writes a nested number as a double. The mark is a code point that is no character; a
# message that holds it all the same is parsed unmarked.
_MARK = "\ufdd0"
_STRING_OR_NUMBER = (
    r'("[^"\\]*+(?:\\.[^"\\]*+)*+")'
    r"|(?<![\w.+-])(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)(?![\w.+-])(?!\s*:)"
)


def _marked_numbers(value: Column) -> Column:
    """Every number as a string between marks. One pass marks strings and numbers alike; a
    string then has an empty number behind it, which goes again."""
    both = F.regexp_replace(value, _STRING_OR_NUMBER, f'$1"{_MARK}$2{_MARK}"')
    return F.replace(both, F.lit(f'"{_MARK}{_MARK}"'), F.lit(""))


def _unmarked(text: Column) -> Column:
    """Numbers as they were written."""
    bare = F.replace(F.regexp_replace(text, f'"{_MARK}([^{_MARK}"]+){_MARK}"', "$1"), F.lit(_MARK), F.lit(""))
    return F.when(F.contains(text, F.lit(_MARK)), bare).otherwise(text)


def _data_text(value: Column, data: Column) -> Column:
    """Payload as JSON text. The map parse drops the quotes of a JSON string, so the
    few messages whose data is a string are restored from a variant parse."""
    member = F.try_variant_get(F.try_parse_json(value), "$.data", "variant")
    is_text = value.rlike(r'"data"\s*:\s*"') & (F.schema_of_variant(member) == "STRING")
    return F.when(F.coalesce(is_text, F.lit(False)), F.to_json(member)).otherwise(data)


def _extras_text(value: Column, fields: Column) -> Column:
    """JSON of the unnamed fields; parsed a second time only where some exist."""
    unnamed = F.exists(F.map_keys(fields), lambda k: ~k.isin(NAMED_FIELDS))
    typed = F.to_json(
        F.map_filter(
            F.from_json(value, "map<string,variant>"), lambda k, v: ~k.isin(NAMED_FIELDS)
        )
    )
    return F.when(unnamed, typed).otherwise(F.lit("{}"))


def parse_envelopes(
    messages: DataFrame, value: str = "value", headers: str | None = "headers"
) -> DataFrame:
    """Add the typed header columns, ``data``, ``extras`` and ``reject_reason``.

    Remaining input columns (for example ``ingest_time``) are kept. A message is
    undecodable when it is not a JSON object, its time is not RFC 3339 or its tags
    are not a list.
    """
    body = F.col(value)
    whole = F.when(F.contains(body, F.lit(_MARK)), body).otherwise(_marked_numbers(body))
    parsed = messages.withColumn("_fields", F.from_json(whole, "map<string,string>"))
    fields = F.col("_fields")
    time_text = _unmarked(F.element_at(fields, "time"))
    tags_text = _unmarked(F.element_at(fields, "tags"))
    tags = F.from_json(tags_text, "array<string>")
    time = F.when(time_text.rlike(RFC3339), time_text.try_cast("timestamp"))
    bad = (
        fields.isNull()
        | (time_text.isNotNull() & time.isNull())
        | (tags_text.isNotNull() & tags.isNull())
    )
    columns = {name: _unmarked(F.element_at(fields, name)) for name in HEADER_FIELDS}
    columns["time"] = time
    columns["tags"] = tags
    columns["data"] = _data_text(body, _unmarked(F.element_at(fields, "data")))
    columns["data_base64"] = _unmarked(F.element_at(fields, "data_base64"))
    columns["extras"] = _extras_text(body, fields)
    if headers is not None:
        columns["data_index_key"] = F.element_at(F.col(headers), fv.HEADER_DATA_INDEX_KEY)
        columns["voids_id"] = F.element_at(F.col(headers), fv.HEADER_VOIDS_ID)
    columns["reject_reason"] = F.when(bad, F.lit("undecodable"))
    return parsed.withColumns(columns).drop("_fields")


def split_rejects(checked: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted without the reason column, rejected with it)."""
    accepted = checked.where(F.col(reason).isNull()).drop(reason)
    return accepted, checked.where(F.col(reason).isNotNull())
