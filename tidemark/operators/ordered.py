"""Ordered operators that survive a group holding a large share of all rows.

A plain window over a hot group sends that group to one task. Here rows are cut into
ordered chunks, each chunk is processed on its own, and only one summary row per
(group, chunk) is ordered across chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

_CHUNK = "_chunk"


def _range_chunks(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """Chunks from a range partitioning of the order itself. The cut points come from
    sampling, so the result is settled once and both passes read the same chunks."""
    args = ([partitions] if partitions else []) + order
    return settle(df.repartitionByRange(*args).withColumn(_CHUNK, F.spark_partition_id().cast("long")))


def running_stats(
    df: DataFrame,
    group: list[str],
    order: list[str],
    *,
    number: str | None = None,
    running: dict[str, str] | None = None,
    previous: dict[str, str] | None = None,
    chunk: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add per-group ordered columns.

    ``number``: row number from 1. ``running``: output name to the column summed up to
    and including the row. ``previous``: output name to the column read from the row
    before. ``chunk`` must not decrease along ``order`` (for example a truncated time);
    without it chunks come from range partitioning. ``order`` should be a total order.
    """
    running, previous = running or {}, previous or {}
    keys = list(group)
    if chunk is None:
        base = _range_chunks(df, keys + [c for c in order if c not in keys], partitions)
    else:
        base = df.withColumn(_CHUNK, chunk)
    within = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {"_n": F.row_number().over(within)}
    local |= {f"_s_{n}": F.sum(c).over(so_far) for n, c in running.items()}
    local |= {f"_p_{n}": F.lag(c).over(within) for n, c in previous.items()}
    stepped = base.withColumns(local)

    last = F.struct(*order)
    summary = base.groupBy(*keys, _CHUNK).agg(
        F.count("*").alias("_rows"),
        *[F.sum(c).alias(f"_t_{n}") for n, c in running.items()],
        *[F.max_by(F.struct(F.col(c).alias("v")), last).alias(f"_l_{n}") for n, c in previous.items()],
    )
    across = Window.partitionBy(*keys).orderBy(_CHUNK) if keys else Window.orderBy(_CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *keys,
        _CHUNK,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in running],
        *[F.lag(f"_l_{n}").over(across).alias(f"_last_{n}") for n in previous],
    )
    joined = stepped.join(offsets, [*keys, _CHUNK])
    out = {}
    if number:
        out[number] = (F.col("_n") + F.col("_rows_before")).cast("long")
    for n in running:
        out[n] = F.coalesce(F.col(f"_s_{n}"), F.lit(0)) + F.col(f"_before_{n}")
    for n in previous:
        out[n] = F.when(F.col("_n") == 1, F.col(f"_last_{n}")["v"]).otherwise(F.col(f"_p_{n}"))
    return joined.withColumns(out).select(*df.columns, *out)


def order_breaks(rows: DataFrame, group: str, arrival: list[str], stored: str, chunk: Column) -> DataFrame:
    """Per group: rows, and rows whose ``stored`` value is below the row that arrived
    before it."""
    seen = running_stats(rows, [group], arrival, previous={"_before": stored}, chunk=chunk)
    return seen.groupBy(group).agg(
        F.count("*").alias("row_count"),
        F.sum(F.when(F.col("_before") > F.col(stored), 1).otherwise(0)).alias("order_breaks"),
    )
