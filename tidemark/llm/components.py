"""Connected components of a table of links, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node that can be reached) for every node of a
    link. Smallest labels travel over links, and every round also replaces a label by the
    label of that label, so long chains shorten by half. Each round is a written table; the
    driver sees one count a round."""
    with scratch(links.sparkSession) as keep:
        return keep(_settled(links, a, b))


def _settled(links: DataFrame, a: str, b: str) -> DataFrame:
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = written(pairs.union(pairs.select("v", "u")).distinct(), "edges")
    labels = edges.groupBy("u").agg(F.min("v").alias("least"))
    labels = written(labels.select(F.col("u").alias("node"), F.least("u", "least").alias("component")), "labels")
    while True:
        with scratch(links.sparkSession) as keep:
            moved = _round(edges, labels)
            still = moved.where("old <> component").limit(1).count()
            labels = keep(written(moved.select("node", "component"), "labels"))
        if not still:
            return labels


def _round(edges: DataFrame, labels: DataFrame) -> DataFrame:
    heard = (
        edges.join(labels, F.col("v") == F.col("node"))
        .groupBy("u")
        .agg(F.min("component").alias("heard"))
    )
    lower = written(
        labels.join(heard, F.col("node") == F.col("u")).select(
            "node", F.col("component").alias("old"), F.least("component", "heard").alias("component")
        ),
        "heard",
    )
    target = lower.select(F.col("node").alias("label"), F.col("component").alias("onward"))
    return written(
        lower.join(target, F.col("component") == F.col("label"), "left").select(
            "node", "old", F.coalesce("onward", "component").alias("component")
        ),
        "moved",
    )
