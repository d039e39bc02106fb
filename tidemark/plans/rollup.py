"""Latest values that are kept up instead of computed anew.

The table holds partial maxima: each update writes the newest value per key of its own rows,
in a folder of its bucket and of the update's name. Taking the newest of several partial
results is the same as taking it over all rows, in any order and however often one is
counted, so late, repeated and replayed updates need no care, and an update reads nothing
but its own rows. ``merge`` joins the parts of buckets that have many; what it leaves behind
when it is stopped is read once more and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import decode
from tidemark.operators.dedup import keep_latest
from tidemark.plans.lake import RawEventTable, path_exists
from tidemark.streaming.consume import consume

SIGNALS = "subject string, name string, timestamp timestamp, pos int, value double"


class LatestTable:
    """Newest row per key, by ``order`` and then the other columns."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str = SIGNALS,
        keys: tuple[str, ...] = ("subject", "name"),
        order: tuple[str, ...] = ("timestamp",),
        buckets: int = 64,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T._parse_datatype_string(schema)
        self.keys, self.order, self.buckets = list(keys), list(order), buckets

    def _bucket(self, *key) -> F.Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, part: str) -> None:
        placed = rows.withColumns({"bucket": self._bucket(self.keys[0]), "part": F.lit(part)})
        arranged = placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *self.keys)
        writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "part").parquet(self.root)

    def update(self, rows: DataFrame, name: str) -> None:
        """Take rows in. The same name replaces what it wrote."""
        self._write(keep_latest(rows.select(*self.schema.names), self.keys, self.order), name)

    def parts(self) -> DataFrame:
        """All partial results, with their ``bucket`` and ``part``."""
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("part", T.StringType())])
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root)

    def read(self, first_key: str | None = None) -> DataFrame:
        """The newest rows; one value of the first key reads one bucket."""
        rows = self.parts()
        if first_key is not None:
            rows = rows.where((F.col("bucket") == self._bucket(F.lit(first_key))) & (F.col(self.keys[0]) == first_key))
        return keep_latest(rows.drop("bucket", "part"), self.keys, self.order)

    def merge(self, name: str, most_parts: int = 8) -> int:
        """Join the parts of every bucket that has more than ``most_parts``; the others are
        not read. Returns how many folders went."""
        held = self.parts().select("bucket", "part").distinct()
        full = held.groupBy("bucket").agg(F.collect_set("part").alias("parts")).where(F.size("parts") > most_parts).collect()
        if not full:
            return 0
        rows = self.parts().where(F.col("bucket").isin([r.bucket for r in full]))
        self._write(keep_latest(rows.drop("bucket", "part"), self.keys, self.order), name)
        hadoop, gone = self.spark._jvm.org.apache.hadoop.fs, 0
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in full:
            for part in row.parts:
                if part != name:
                    path = hadoop.Path(f"{self.root}/bucket={row.bucket}/part={names.escapePathName(part)}")
                    gone += path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return gone


def latest_signals_query(
    table: RawEventTable,
    latest: LatestTable,
    checkpoint: str,
    chain: int | str,
    contract: str,
    consumer: str = "latest_signals",
    trigger: dict | None = None,
    max_commits: int = 100,
    most_parts: int = 8,
) -> StreamingQuery:
    """Keep the latest signals up from the commits of the table."""

    def update(rows: DataFrame, name: str) -> None:
        decoded = decode.decode_arrays(rows, chain, contract)
        latest.update(decode.inline_rows(decoded, "signals", "subject"), name)
        latest.merge(f"merge-{name}", most_parts)

    return consume(table, consumer, update, checkpoint, max_commits, trigger)
