"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows handed to Python at once: texts may be long, so the batch stays small.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the given tables, with the settings the operators rely on."""
    for key, value in (
        ("spark.sql.session.timeZone", "UTC"),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
    ):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``. A folder of this machine is used
    only by a local master without that setting; a cluster without it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Paths of the tables written in each open ``scratch``, innermost last.
_OPEN: list[list[str]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, survives lost executors. What
    was shuffled for it is deleted as soon as the table stands."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if _OPEN:
        _OPEN[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those given to the function
    that this yields; these belong to what is around. Only written tables may be given on."""
    paths: list[str] = []
    _OPEN.append(paths)

    def keep(table: DataFrame) -> DataFrame:
        paths.remove(table.scratch_path)
        if len(_OPEN) > 1:
            _OPEN[-2].append(table.scratch_path)
        return table

    try:
        yield keep
    finally:
        _OPEN.pop()
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def arrow_schema(df_schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(df_schema))


def map_rows(
    df: DataFrame, columns: list[str], fn: Callable[..., Iterator[dict] | dict], schema: str
) -> DataFrame:
    """Apply ``fn(*column_lists) -> dict of lists`` to every Arrow batch of ``columns``."""
    target = arrow_schema(schema, df.sparkSession)

    def run(batches):
        for batch in batches:
            out = fn(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.select(*columns).mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit of a 64-bit word over the output."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# ---- words of many texts at once

_GOLD = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)
_STEP_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLD))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
CHUNK_BYTES = 2 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_STEP, _STEP_INVERSE)):
            steps = np.full(n, base)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, one after the other,
    and the place in them at which each text begins (one more entry at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    powers, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    begins = np.concatenate([[0], np.cumsum(sizes)]) + 1
    return hashes, np.searchsorted(starts, begins)


def chunks_of_bytes(texts: list[bytes], limit: int = CHUNK_BYTES):
    """Ranges of texts of about ``limit`` bytes together; a longer text is a range of its own."""
    first = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)
