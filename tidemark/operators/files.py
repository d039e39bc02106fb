"""File inventories: listing, backfill planning, compaction planning, orphans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.text import parse_size, path_prefix
from tidemark.operators.ordered import running_stats


def new_files(listed: DataFrame, registered: DataFrame) -> DataFrame:
    """Parquet files not registered yet, once each."""
    wanted = listed.where(F.col("path").endswith(".parquet")).dropDuplicates(["path"])
    return wanted.join(registered.select("path"), "path", "left_anti")


def prefix_status(listed: DataFrame, registered: DataFrame) -> DataFrame:
    """Per directory prefix: files, how many are registered, and new/partial/done."""
    wanted = listed.where(F.col("path").endswith(".parquet")).select("path").distinct()
    known = registered.select("path").distinct().withColumn("_known", F.lit(1))
    counted = (
        wanted.join(known, "path", "left")
        .groupBy(path_prefix(F.col("path")).alias("prefix"))
        .agg(F.count("*").alias("files"), F.count("_known").alias("registered"))
    )
    status = (
        F.when(F.col("registered") == 0, F.lit("new"))
        .when(F.col("registered") == F.col("files"), F.lit("done"))
        .otherwise(F.lit("partial"))
    )
    return counted.withColumn("status", status)


def registration_batches(files: DataFrame, cap: int = fv.FILES_PER_SNAPSHOT) -> DataFrame:
    """Number files within their prefix and cut every prefix into batches of ``cap``."""
    numbered = running_stats(
        files.withColumn("prefix", path_prefix(F.col("path"))), ["prefix"], ["path"], number="file_number"
    )
    return numbered.withColumn("batch", F.floor((F.col("file_number") - 1) / cap).cast("long"))


def plan_compaction(
    data_files: DataFrame,
    partition: list[str],
    target_bytes: int,
    limit: int = fv.MERGE_FALLBACK,
) -> DataFrame:
    """Files to merge with their group: neighbours by path inside one partition, each
    group starting in one target-sized stretch and holding at most ``limit`` files.
    Files already at target size and groups of one are left alone."""
    small = data_files.where(F.col("bytes") < target_bytes)
    placed = running_stats(
        small, partition, ["path"], number="_number", running={"_upto": "bytes"}
    ).withColumns(
        {
            "size_slot": F.floor((F.col("_upto") - F.col("bytes")) / target_bytes).cast("long"),
            "count_slot": F.floor((F.col("_number") - 1) / limit).cast("long"),
        }
    )
    groups = [*partition, "size_slot", "count_slot"]
    sized = placed.groupBy(*groups).agg(F.count("*").alias("group_files"), F.sum("bytes").alias("group_bytes"))
    # A group holds at most ``limit`` files, so this join has no hot key.
    return placed.join(sized.where("group_files > 1"), groups).drop("_number", "_upto")


def orphan_files(listing: DataFrame, referenced: DataFrame, as_of: Column, window: int = fv.ORPHAN_SECONDS) -> DataFrame:
    """Listed files no ledger row refers to, older than the window; a negative window
    disables the sweep."""
    if window < 0:
        return listing.limit(0)
    old = listing.where(F.col("modified") < as_of - F.make_dt_interval(secs=F.lit(window)))
    return old.join(referenced.select("path").distinct(), "path", "left_anti")


def unreferenced_files(data_files: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Removed files no retained snapshot needs. Expiry removes a prefix of the ids, so
    the oldest retained id decides: a file removed at or before it is unreachable."""
    oldest = snapshots.agg(F.min("snapshot_id"))
    return data_files.where(F.col("removed_snapshot") <= oldest.scalar())


def delete_fractions(data_files: DataFrame, deletes: DataFrame) -> DataFrame:
    """Per file the share of deleted rows; deletes are reduced before the join.

    Marks are told apart as bits of words of 64 rows, so what is held and shuffled are words
    and not rows. All marks without a row count as one."""
    row = F.col("row_index").cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), row.bitwiseAND(63).cast("int"))
    words = deletes.groupBy("path", F.shiftright(row, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = F.coalesce(F.bit_count("_bits"), F.lit(1)).cast("long")
    removed = words.groupBy("path").agg(F.sum(marked).alias("deleted_rows"))
    return data_files.join(removed, "path").withColumn("fraction", F.col("deleted_rows") / F.col("rows"))


def delete_heavy(data_files: DataFrame, deletes: DataFrame, threshold: float = fv.DELETE_THRESHOLD) -> DataFrame:
    """Files at or above the threshold; a negative threshold disables the step."""
    fractions = delete_fractions(data_files, deletes)
    if threshold < 0:
        return fractions.limit(0)
    return fractions.where(F.col("fraction") >= threshold)


def file_backlog(data_files: DataFrame) -> DataFrame:
    """Per table: file count, total bytes and average size."""
    return data_files.groupBy("table_name").agg(
        F.count("path").alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("total_bytes"),
        F.coalesce(F.sum("bytes") / F.count("path"), F.lit(0.0)).alias("average_bytes"),
    )


def merge_group_limit(backlog: DataFrame, memory_limit: str = "", pin: int = 0) -> DataFrame:
    """One row: how many files one merge may rewrite. A pin wins; without a usable
    budget or any file the fallback applies."""
    budget = F.floor(parse_size(F.lit(memory_limit)) * fv.MERGE_BUDGET_FRACTION)
    largest = F.max(F.when(F.col("files") > 0, F.floor(F.col("total_bytes") / F.col("files"))))
    derived = F.least(
        F.greatest(F.floor(budget / F.col("largest")), F.lit(1)), F.lit(fv.MERGE_HARD_CEILING)
    )
    limit = (
        F.lit(min(pin, fv.MERGE_HARD_CEILING))
        if pin > 0
        else F.when(
            (parse_size(F.lit(memory_limit)) <= 0) | F.coalesce(F.col("largest") <= 0, F.lit(True)),
            F.lit(fv.MERGE_FALLBACK),
        ).otherwise(derived)
    )
    return backlog.agg(largest.alias("largest")).select(limit.cast("long").alias("file_limit"))


def restore_gap(listing: DataFrame, data_files: DataFrame, restored_to: Column) -> DataFrame:
    """Files the restored ledger lacks, classed by age around the restore point."""
    missing = listing.join(data_files.select("path").distinct(), "path", "left_anti")
    kind = F.when(F.col("modified") > restored_to, F.lit("after_restore_point")).otherwise(
        F.lit("before_restore_point")
    )
    return missing.withColumn("class", kind)


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Objects below ``root`` whose key starts with ``prefix``: key, size, modified.

    Only file metadata is read. Dot-files and anything below a dot-folder are hidden;
    a missing prefix lists nothing. The folder part of the prefix narrows the listing.
    """
    base = root.rstrip("/")
    folder = prefix.rsplit("/", 1)[0] if "/" in prefix else ""
    start = f"{base}/{folder}" if folder else base
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(start)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return spark.createDataFrame([], "path string, key string, size bigint, modified timestamp")
    qualified = file_system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(base)).toString()
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(start)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    bare = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/*", "/")
    keyed = (
        listed.withColumns({"_bare": bare(F.col("path")), "_from": F.length(bare(F.lit(qualified))) + 2})
        .withColumn("key", F.expr("substring(_bare, _from)"))
        .select("path", "key", "size", "modified")
    )
    return visible_objects(keyed, prefix)


def visible_objects(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Keys that start with the prefix; dot-files and dot-folders are hidden."""
    return listing.where(F.col("key").startswith(prefix) & ~F.col("key").rlike(r"(^|/)\."))


def listing_order(listing: DataFrame, key: str = "key") -> DataFrame:
    """The listing in key order (a distributed range sort)."""
    return listing.orderBy(key)
