"""Shards by jump consistent hashing, in SQL expressions only.

The published generator steps a 64-bit key by ``key * 2862933555777941757 + 1`` and jumps
to ``floor((b + 1) * 2^31 / ((key >> 33) + 1))`` until the jump leaves the shard range; the
last bucket inside the range is the shard. No ring table exists, and one more shard takes
rows only into itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the multiplier of the published generator, as high and low 32 bits.
MULTIPLIER = 2862933555777941757
STEP_HIGH, STEP_LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
LOW_32 = 0xFFFFFFFF

# Jumps made in one fold. A key needs about ln(shards) of them; the few keys that need more
# go on in a second fold, which nothing else evaluates.
FIRST_JUMPS = 24


def _wide(value: int) -> Column:
    return F.lit(value).cast("long")


def _times_low(x: Column, factor: int) -> tuple[Column, Column]:
    """Low 32 bits and the rest of ``x * factor`` for two numbers below 2^32, without
    leaving the range of a signed long."""
    small = x.bitwiseAND(_wide(0xFFFF)) * _wide(factor)
    large = F.shiftright(x, 16) * _wide(factor)
    low = small + F.shiftleft(large.bitwiseAND(_wide(0xFFFF)), 16)
    return low.bitwiseAND(_wide(LOW_32)), F.shiftright(low, 32) + F.shiftright(large, 16)


def _fold(state: Column, jumps: Column, shards: int) -> Column:
    def step(s: Column, _: Column) -> Column:
        low, carry = _times_low(s["low"], STEP_LOW)
        cross_high = _times_low(s["high"], STEP_LOW)[0] + _times_low(s["low"], STEP_HIGH)[0]
        next_low = low + _wide(1)
        high = (carry + cross_high + F.shiftright(next_low, 32)).bitwiseAND(_wide(LOW_32))
        stretch = F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")
        jump = F.floor((s["next"] + 1).cast("double") * stretch)
        moved = F.struct(
            high.alias("high"),
            next_low.bitwiseAND(_wide(LOW_32)).alias("low"),
            s["next"].alias("bucket"),
            jump.cast("long").alias("next"),
        )
        return F.when(s["next"] >= _wide(shards), s).otherwise(moved)

    return F.aggregate(jumps, state, step)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards - 1`` of a long key. A null key counts as 0."""
    key = F.coalesce(key.cast("long"), _wide(0))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(_wide(LOW_32)).alias("low"),
        _wide(-1).alias("bucket"),
        _wide(0).alias("next"),
    )
    first = min(shards, FIRST_JUMPS)
    state = _fold(start, F.sequence(F.lit(1), F.lit(first)), shards)
    if shards > first:
        rest = _fold(state, F.sequence(F.lit(first + 1), F.lit(shards)), shards)
        state = F.when(state["next"] < _wide(shards), rest).otherwise(state)
    return state["bucket"].cast("int")


def assign_shards(
    df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col``, ``size``, ``text_crc32``, ``law``, ``shard``,
    ``slot``, ``grown_shard``.

    The law is ``key``: id and shard count decide. ``slot`` numbers the rows of a shard
    from 0 without gaps. It is found in two steps, so that no task holds a shard: rows are
    numbered inside (shard, chunk) with about the square root of all rows as chunks, and
    the sizes of the chunks, as few, give the number at which each chunk starts.

    Null ids count as key 0 and lie in the shard of 0; repeated ids lie together and get
    different slots; a null text has size 1 and the checksum of no bytes; an empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    chunks = max(1, math.isqrt(df.count()))
    key = F.col(id_col).cast("long")
    # Null and repeated ids spread over chunks by what the row holds.
    chunk = F.pmod(F.xxhash64(F.col(id_col), text), _wide(chunks))
    keyed = df.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        chunk.alias("chunk"),
    )
    inside = Window.partitionBy("shard", "chunk").orderBy(id_col, "text_crc32", "size")
    numbered = keyed.withColumn("place", F.row_number().over(inside) - 1)
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("shard", "chunk")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "chunk", F.coalesce(F.sum("rows").over(before), _wide(0)).alias("start"))
    )
    return numbered.join(starts, ["shard", "chunk"]).select(
        id_col,
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )


def op5_sharding(spark, directory):
    """All documents in shards 0 to 15 by jump consistent hashing."""
    from tidemark.llm.common import load

    return assign_shards(load(spark, directory, "documents"))


QUERIES = {"op5_sharding": op5_sharding}
ORACLES: dict[str, str] = {}
