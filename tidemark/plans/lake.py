"""The ``raw_events`` table: plain partitioned, sorted Parquet with numbered commits.

Data lie below ``data/type=…/year=…/month=…/day=…/batch=<attempt>``: type and date come first,
so a read of one day lists that day and nothing else, however many batches there are. A
write goes to folders of its own attempt. Once its job is done it is committed by one small
file ``commits/<number>.json``, which names the attempt and the partitions it touched. Reads
join with the commits, so what an unfinished or repeated attempt left is never seen, and a
batch that is committed is not written again. ``fold_commits`` joins old commits to one table.

The number is taken at the commit: the file is moved to the next free name, and moving onto
an existing name fails. It is the ``snapshot_id`` of the rows. Whoever has read all commits
up to a number has missed nothing, even if writers overtake each other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark import schemas
from tidemark.operators.dedup import unseen_rows
from tidemark.operators.reports import reject_class

COMMITS = """snapshot_id long, batch string, attempt string, committed_at timestamp, rows long,
partitions array<struct<type:string,year:int,month:int,day:int>>"""
PROGRESS = "consumer string, snapshot_id long, updated_at timestamp"

# Days that a read names one by one; a longer range lists whole months, then the type.
MOST_DAYS = 400


def write_options(codec: str = "", parquet_version: str = "", target_bytes: int = 0, row_bytes: int = 0) -> dict:
    """Writer options: an unknown codec falls back to the default, an unknown format
    version is left to Spark, and a size target becomes a row cap per file."""
    chosen = codec.lower() if codec.lower() in fv.CODECS else fv.DEFAULT_CODEC
    options = {"compression": chosen}
    if parquet_version in ("1", "2"):
        options["parquet.writer.version"] = f"v{parquet_version}"
    if target_bytes > 0 and row_bytes > 0:
        options["maxRecordsPerFile"] = str(max(target_bytes // row_bytes, 1))
    return options


# Point reads: row groups are told apart by the sort on subject, and by bloom filters on both
# keys. The writer leaves the filter out where a column is stored by dictionary, which serves
# as well for subjects; ids hardly repeat, so theirs is switched off.
POINT_READS = {
    "parquet.bloom.filter.enabled#subject": "true",
    "parquet.bloom.filter.enabled#id": "true",
    "parquet.enable.dictionary#id": "false",
    # Sized by what a row group holds; the fixed size is a megabyte a column.
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def with_partition_columns(raw_events: DataFrame) -> DataFrame:
    return raw_events.withColumns(
        {"year": F.year("time"), "month": F.month("time"), "day": F.dayofmonth("time")}
    )


def clustered(rows: DataFrame, layout: str = "rebalance", partitions: int | None = None) -> DataFrame:
    """Arrange rows for a partitioned, sorted write.

    ``rebalance`` (ingest): one shuffle on the partition columns; adaptive execution
    splits a hot day by map output, copies included, and joins small ones.
    ``range`` (maintenance): cut the (type, date, subject, time) order itself, so each
    file covers a narrow subject range. Further columns split a hot subject.
    """
    keys = [*schemas.PARTITION_COLUMNS, "batch"]
    if layout == "range":
        cut = [*keys, "subject", "time", "ingest_time", "id"]
        arranged = rows.repartitionByRange(*([partitions] if partitions else []), *cut)
    else:
        arranged = rows.hint("rebalance", *[F.col(k) for k in keys])
    return arranged.sortWithinPartitions(*keys, "subject", "time")


def _utc(bound: datetime) -> datetime:
    return bound.replace(tzinfo=timezone.utc) if bound.tzinfo is None else bound.astimezone(timezone.utc)


def date_predicate(start: datetime | None, end: datetime | None) -> Column:
    """``start <= time < end`` plus the partition predicate Spark does not derive."""
    stamp = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    out = F.lit(True)
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        utc = _utc(bound)
        number = utc.year * 10000 + utc.month * 100 + utc.day
        out = out & (
            (stamp >= number) & (F.col("time") >= F.lit(utc))
            if is_start
            else (stamp <= number) & (F.col("time") < F.lit(utc))
        )
    return out


# ---- small files: commits and cursors


class SmallFiles:
    """One-line JSON files of a folder, moved into place whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._jvm = spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self._jvm.Path(f"{self.folder}/{name}")

    def put(self, name: str, record: dict, replace: bool = False) -> bool:
        """False if ``name`` exists and may not be replaced; nothing is written then."""
        draft = self._path(f"_{uuid.uuid4().hex}")
        files = draft.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = files.create(draft, False)
        out.write(bytearray((json.dumps(record) + "\n").encode()))
        out.close()
        context = self._jvm.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(self._jvm, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            context.rename(draft, self._path(name), how)
        except Exception as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def one(self, name: str) -> dict | None:
        path = self._path(name)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        path = self._path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)

    def names(self) -> list[str]:
        if not path_exists(self.spark, self.folder):
            return []
        path = self._jvm.Path(self.folder)
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return [n for n in (s.getPath().getName() for s in listed) if n[0] not in "._"]

    def read(self, schema: str) -> DataFrame:
        if not path_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(self.folder)


class RawEventTable:
    """Reads and writes of one table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = f"{self.root}/data"
        self._commits = SmallFiles(spark, f"{self.root}/commits")
        self._batches = SmallFiles(spark, f"{self.root}/batches")
        self._progress = SmallFiles(spark, f"{self.root}/progress")
        self._last = 0

    # ---- writing

    def write(
        self,
        raw_events: DataFrame,
        batch: str,
        time: datetime | None = None,
        layout: str = "rebalance",
        **options: str,
    ) -> int:
        """Write rows as ``batch`` and return its snapshot. ``time`` fills ``ingest_time``
        where the rows do not bring it. A committed batch stays as it is."""
        return self.write_batches(raw_events.withColumn("batch", F.lit(batch)), [batch], time, layout, **options)[batch]

    def write_batches(
        self, rows: DataFrame, batches: list[str], time: datetime | None = None, layout: str = "rebalance", **options: str
    ) -> dict[str, int]:
        """Several batches in one job; ``rows`` say their ``batch``. They are committed in the
        order of ``batches``, those without rows as well."""
        done = {b: n for b in batches if (n := self.snapshot_of(b)) is not None}
        wanted = [b for b in batches if b not in done]
        if done and wanted:
            rows = rows.where(F.col("batch").isin(wanted))
        attempts = self.prepare(rows, wanted, time, layout, **options) if wanted else []
        return done | {a["batch"]: self.commit(**a) for a in attempts}

    def prepare(
        self, rows: DataFrame, batches: list[str], time: datetime | None = None, layout: str = "rebalance", **options: str
    ) -> list[dict]:
        """The first half of a write: files that nobody sees until ``commit(**attempt)``."""
        attempt = uuid.uuid4().hex[:12]
        if "ingest_time" not in rows.columns:
            rows = rows.withColumn("ingest_time", F.lit(time).cast("timestamp"))
        columns = [c for c in (*schemas.RAW_EVENT_COLUMNS, "ingest_time") if c in rows.columns]
        rows = rows.select(*columns, F.concat("batch", F.lit(f".{attempt}")).alias("batch"))
        arranged = clustered(with_partition_columns(rows), layout)
        # Which partitions were written is observed by the job that writes them.
        seen = Observation()
        part = F.struct("batch", *schemas.PARTITION_COLUMNS)
        counted = arranged.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(part).alias("parts"))
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.partitionBy(*schemas.PARTITION_COLUMNS, "batch")
        writer.options(**{**write_options(), **POINT_READS, **options}).parquet(self.data)
        parts: dict[str, list] = {}
        for p in seen.get["parts"] or []:
            parts.setdefault(p["batch"], []).append({k: p[k] for k in schemas.PARTITION_COLUMNS})
        rows_written = seen.get["rows"] if len(batches) == 1 else None
        names = {b: f"{b}.{attempt}" for b in batches}
        return [{"batch": b, "attempt": n, "partitions": parts.get(n, []), "rows": rows_written} for b, n in names.items()]

    def commit(self, batch: str, attempt: str, partitions: list[dict], rows: int | None = None) -> int:
        """Make ``attempt`` the rows of ``batch`` under the next free number. Of two attempts
        at one batch the first commit counts."""
        record = {
            "batch": batch,
            "attempt": attempt,
            "committed_at": datetime.now(timezone.utc).isoformat(),
            "rows": rows,
            "partitions": partitions,
        }
        number = self._last or self.last_snapshot()
        while True:
            number += 1
            if self._commits.put(f"{number:012d}.json", {"snapshot_id": number, **record}):
                self._last = number
                # Only a shortcut for ``snapshot_of``: without it a batch is written again and
                # its second commit does not count.
                self.mark(batch, number)
                return number

    def mark(self, batch: str, snapshot_id: int) -> None:
        """Note under which snapshot a batch, or a part of one, is committed."""
        self._batches.put(self._batch_file(batch), {"snapshot_id": snapshot_id})

    def _batch_file(self, batch: str) -> str:
        return f"b-{self._escaped(batch)}.json"

    def snapshot_of(self, batch: str) -> int | None:
        """The snapshot of a committed batch."""
        found = self._batches.one(self._batch_file(batch))
        return found and found["snapshot_id"]

    # ---- commits

    def last_snapshot(self) -> int:
        folded = self.commits_folded().agg(F.max("snapshot_id")).first()[0] if path_exists(self.spark, self._folded) else 0
        return max((int(n.split(".")[0]) for n in self._commits.names()), default=folded or 0)

    @property
    def _folded(self) -> str:
        return f"{self.root}/commits-folded"

    def commits_folded(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(self._folded)

    def fold_commits(self, upto: int) -> int:
        """Join the commit files up to a number into a table and remove them, so that reads
        open few files. Give the consumer floor: a consumer streams only what still is a file
        of its own. A run that stops half way leaves commits in both places, which reads
        reduce to one."""
        old = [n for n in self._commits.names() if int(n.split(".")[0]) <= upto]
        if old:
            known = self._commits.read(COMMITS).where(F.col("snapshot_id") <= upto)
            known.repartition(1).write.mode("append").parquet(self._folded)
            for name in old:
                self._commits.remove(name)
        return len(old)

    def commits(self) -> DataFrame:
        """One row per committed batch: the first commit of each."""
        found = self._commits.read(COMMITS)
        if path_exists(self.spark, self._folded):
            found = found.unionByName(self.commits_folded())
        rest = [c for c in found.columns if c != "batch"]
        return found.groupBy("batch").agg(F.min_by(F.struct(*rest), "snapshot_id").alias("_first")).select("batch", "_first.*")

    def snapshots(self) -> DataFrame:
        """``snapshot_id`` and ``snapshot_time`` of every commit."""
        return self.commits().select("snapshot_id", F.col("committed_at").alias("snapshot_time"))

    def read_stream(self, max_commits: int = 100) -> DataFrame:
        """The commits as a stream, in the order in which they appear. Their rows are read
        with ``rows_of``; ``streaming.jobs.consume`` does both."""
        path = self._commits._path("")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)
        stream = self.spark.readStream.schema(COMMITS).option("maxFilesPerTrigger", max_commits)
        return stream.json(self._commits.folder)

    def rows_of(self, commits: Iterable[Row]) -> DataFrame:
        """Rows of some commits: only the folders that these have written are listed."""
        folders = [
            f"{self._folder(p['type'])}/year={p['year']}/month={p['month']}/day={p['day']}/batch={self._escaped(c['attempt'])}"
            for c in commits
            for p in c["partitions"]
        ]
        return self._visible(self._scan(folders)).select(*schemas.RAW_EVENT_COLUMNS, "snapshot_id", "ingest_time")

    # ---- cursors

    def record_progress(self, consumer: str, snapshot_id: int, at: datetime) -> None:
        """The cursor of a consumer: one file, replaced whole."""
        record = {"consumer": consumer, "snapshot_id": snapshot_id, "updated_at": _utc(at).isoformat()}
        self._progress.put(f"{self._escaped(consumer)}.json", record, replace=True)

    def progress(self) -> DataFrame:
        return self._progress.read(PROGRESS)

    # ---- reading

    def stored(self, where: Column | None = None, folders: list[str] | None = None) -> DataFrame:
        """All committed rows with the ``file_path`` and ``row_index`` they lie at."""
        rows = self._scan(folders)
        rows = rows if where is None else rows.where(where)
        return self._visible(
            rows.select(
                "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index")
            )
        )

    def read(
        self,
        type: str | None = None,
        start: datetime | None = None,
        end: datetime | None = None,
        subject: str | None = None,
        id: str | None = None,
    ) -> DataFrame:
        """Rows by type, time range, subject and id. Only the folders of the type and the
        dates are listed; partitions, row groups and bloom filters prune the rest."""
        where = date_predicate(start, end)
        for name, value in (("type", type), ("subject", subject), ("id", id)):
            if value is not None:
                where = where & (F.col(name) == value)
        rows = self._scan(self.folders(type, start, end)).where(where)
        return self._visible(rows).select(*schemas.RAW_EVENT_COLUMNS, "snapshot_id", "ingest_time")

    def folders(self, type: str | None, start: datetime | None, end: datetime | None) -> list[str] | None:
        """Patterns of the folders that can hold such rows; None for the whole table."""
        root = self._folder(type) if type is not None else f"{self.data}/type=*"
        if start is None or end is None:
            return None if type is None else [root]
        first, last = _utc(start).date(), _utc(end).date()
        if (last - first).days > MOST_DAYS:
            months = {(y, m) for y in range(first.year, last.year + 1) for m in range(1, 13)}
            inside = sorted(k for k in months if (first.year, first.month) <= k <= (last.year, last.month))
            return [f"{root}/year={y}/month={m}" for y, m in inside] if len(inside) <= MOST_DAYS else [root]
        months: dict[tuple[int, int], list[int]] = {}
        for i in range((last - first).days + 1):
            day = first + timedelta(days=i)
            months.setdefault((day.year, day.month), []).append(day.day)
        return [f"{root}/year={y}/month={m}/day={{{','.join(map(str, days))}}}" for (y, m), days in months.items()]

    def _scan(self, folders: list[str] | None) -> DataFrame:
        """Rows below the folders that exist; a row's ``batch`` is the attempt that wrote it."""
        here = [self.data] if folders is None else folders
        here = [f for f in here if path_exists(self.spark, f)]
        reader = self.spark.read.schema(schemas.TABLE_ROWS)
        if not here:
            path = self._commits._jvm.Path(self.data)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)
            return reader.parquet(self.data).where(F.lit(False))
        return reader.option("basePath", self.data).parquet(*here)

    def _visible(self, rows: DataFrame) -> DataFrame:
        """Rows of committed attempts, with the snapshot that each one got."""
        known = self.commits().select(F.col("attempt").alias("batch"), "snapshot_id")
        return rows.join(known, "batch")

    def _folder(self, type: str) -> str:
        return f"{self.data}/type={self._escaped(type)}"

    def _escaped(self, text: str) -> str:
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return names.escapePathName(text)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, leads to anything."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(sign in path for sign in "*{"):
        found = files.globStatus(hadoop)
        return found is not None and len(found) > 0
    return files.exists(hadoop)


def read_changes(raw_events: DataFrame, first: int, last: int) -> DataFrame:
    return raw_events.where(F.col("snapshot_id").between(first, last))


def read_as_of(raw_events: DataFrame, deletes: DataFrame, snapshot_id: int, keys: list[str]) -> DataFrame:
    """Time travel over rows that carry their snapshot, with deletes held by key."""
    gone = deletes.where(F.col("delete_snapshot_id") <= snapshot_id).select(*keys).distinct()
    return raw_events.where(F.col("snapshot_id") <= snapshot_id).join(gone, keys, "left_anti")


def union_native_and_backfilled(native: DataFrame, backfilled: DataFrame) -> DataFrame:
    """Rows of both origins under one schema; columns an older file lacks are NULL."""
    return native.unionByName(backfilled, allowMissingColumns=True)


def quarantine(rejects: DataFrame, path: str, mode: str = "append", reason: str = "reject_reason") -> None:
    """Write rejected rows whole, with their class, partitioned by reason."""
    rejects.withColumn("reject_class", reject_class(reason)).write.mode(mode).partitionBy(reason).parquet(path)


def append_decoded(
    new: DataFrame,
    path: str,
    batch: str,
    keys: list[str],
    date_column: str,
    lanes: tuple[str, ...] = (),
    seen: DataFrame | None = None,
) -> None:
    """Write the unseen rows of a batch, one per key, below a folder per lane and date; the
    batch is the last folder, so a read of one lane or date lists no other. The same batch
    replaces itself, so nothing is read back; ``seen`` are rows, pruned by the caller, whose
    keys are left out.

    Rows are clustered by lane and date first: a small batch has one file for each."""
    fresh = unseen_rows(new, new.limit(0) if seen is None else seen, keys)
    folders = [*lanes, date_column, "batch"]
    arranged = fresh.withColumn("batch", F.lit(batch)).hint("rebalance", *[F.col(c) for c in folders])
    writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)
