"""Checksummed addresses as a dimension: the checksum is taken once per new address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identity
from tidemark.functions.keccak import checksum_address
from tidemark.plans.lake import path_exists

ADDRESSES = "digits string, address string"


class AddressDimension:
    """``digits`` (40, lower case) and the checksummed ``address``, below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], ADDRESSES)
        # Two learners at once may both have found an address.
        rows = self.spark.read.schema(ADDRESSES).parquet(self.root)
        return rows.groupBy("digits").agg(F.first("address").alias("address"))

    def learn(self, rows: DataFrame, columns: list[str], name: str) -> None:
        """Add the addresses that the identifiers of some columns have and the dimension does
        not. The same name replaces what it wrote."""
        found = F.explode(F.array_distinct(F.array(*[F.lower(identity.digits_of(F.col(c))) for c in columns])))
        new = rows.select(found.alias("digits")).where("digits IS NOT NULL").distinct()
        known = self.read() if not path_exists(self.spark, f"{self.root}/batch={name}") else self.read().limit(0)
        fresh = new.join(known.select("digits"), "digits", "left_anti")
        fresh.withColumn("address", checksum_address(F.col("digits"))).write.mode("overwrite").parquet(f"{self.root}/batch={name}")

    def canonical(self, rows: DataFrame, columns: list[str], ethr: bool = False) -> DataFrame:
        """The identifiers of ``columns`` in canonical form, by equi-joins with the
        dimension: no UDF on the side of the events. NULL where an identifier has no accepted
        form, or an address that was not learned."""
        known = self.read()
        for c in columns:
            named = known.select(F.col("digits").alias(f"_{c}_digits"), F.col("address").alias(f"_{c}_address"))
            rows = rows.withColumn(f"_{c}_digits", F.lower(identity.digits_of(F.col(c)))).join(named, f"_{c}_digits", "left")
            made = identity.canonical_did(F.col(c), ethr=ethr, address=F.col(f"_{c}_address"))
            rows = rows.withColumn(c, made).drop(f"_{c}_digits", f"_{c}_address")
        return rows
