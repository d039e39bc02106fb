"""Bounds on what one commit brings: small arrivals wait for each other.

A micro-batch is first staged, as files that no reader sees. Once the staged batches have
enough bytes, or the oldest is old enough, they are joined to one commit whose files keep to
the bounds; the rows of a file follow from the bytes a row was measured to take.

Staged folders are moved below the name of their bundle before it is written, so a run that
stopped at any point finds whole bundles to finish and staged batches that still wait.
Nothing is lost, and a bundle that is committed is not written again.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.plans.lake import RawEventTable


@dataclass(frozen=True)
class Bounds:
    """Rows and bytes of a file at most; bytes that make a bundle before it is
    ``hard_seconds`` old; and the age at which any bundle is written."""

    rows: int = 100_000
    bytes: int = 128 << 20
    soft_bytes: int = 16 << 20
    hard_seconds: int = 300


class Bundles:
    """Staged micro-batches of one table and the bundles made from them."""

    def __init__(self, table: RawEventTable, bounds: Bounds = Bounds(), **write_options: str):
        self.table, self.bounds, self.options = table, bounds, write_options
        self.staging, self.ready = f"{table.root}/staged", f"{table.root}/bundles"
        # A micro-batch and the listener may both want to write a bundle.
        self._one_at_a_time = threading.Lock()
        self._hadoop = table.spark._jvm.org.apache.hadoop.fs

    # ---- folders

    def _files(self, path):
        return path.getFileSystem(self.table.spark._jsc.hadoopConfiguration())

    def _folders(self, root: str) -> list:
        path = self._hadoop.Path(root)
        files = self._files(path)
        return sorted((s.getPath() for s in files.listStatus(path)), key=str) if files.exists(path) else []

    def waiting(self) -> list[tuple[object, int, datetime]]:
        """(folder, bytes, time) of every finished staged batch."""
        out = []
        for path in self._folders(self.staging):
            files, done = self._files(path), self._hadoop.Path(path, "_SUCCESS")
            if files.exists(done):
                at = files.getFileStatus(done).getModificationTime() / 1000
                size = files.getContentSummary(path).getLength()
                out.append((path, size, datetime.fromtimestamp(at, timezone.utc)))
        return out

    # ---- steps

    def stage(self, rows: DataFrame, name: str) -> None:
        """Keep the rows of a micro-batch; the same name replaces itself until it is bundled."""
        moved = any(self._files(b).exists(self._hadoop.Path(b, f"batch={name}")) for b in self._folders(self.ready))
        if not moved and self.table.snapshot_of(f"staged-{name}") is None:
            rows.write.mode("overwrite").parquet(f"{self.staging}/batch={name}")

    def due(self, as_of: datetime) -> bool:
        held = self.waiting()
        if not held:
            return False
        age = (as_of - min(at for *_, at in held)).total_seconds()
        return sum(size for _, size, _ in held) >= self.bounds.soft_bytes or age >= self.bounds.hard_seconds

    def flush(self, as_of: datetime, force: bool = False) -> list[int]:
        """Finish bundles that were left, and make one of what waits if it is due. Returns
        the snapshots."""
        with self._one_at_a_time:
            return self._flush(as_of, force)

    def _flush(self, as_of: datetime, force: bool) -> list[int]:
        if force or self.due(as_of):
            bundle = f"{self.ready}/bundle-{uuid.uuid4().hex[:12]}"
            for path, *_ in self.waiting():
                target = self._hadoop.Path(bundle, path.getName())
                files = self._files(target)
                files.mkdirs(target.getParent())
                files.rename(path, target)
        done = [self._finish(path, as_of) for path in self._folders(self.ready)]
        return [number for number in done if number is not None]

    def _finish(self, bundle, as_of: datetime) -> int | None:
        names = [p.getName().removeprefix("batch=") for p in self._folders(bundle.toString())]
        if not names:
            self._files(bundle).delete(bundle, True)
            return None
        staged = self.table.spark.read.parquet(*[f"{bundle.toString()}/batch={n}" for n in names])
        size = self._files(bundle).getContentSummary(bundle).getLength()
        count = staged.count()
        # Bytes a row takes here, where it is stored in the same format.
        fitting = self.bounds.bytes * max(count, 1) // max(size, 1)
        cap = {"maxRecordsPerFile": str(max(1, min(self.bounds.rows, fitting)))}
        number = self.table.write(staged, bundle.getName(), as_of, **{**self.options, **cap})
        for name in names:
            self.table.mark(f"staged-{name}", number)
        self._files(bundle).delete(bundle, True)
        return number


class FlushWhenIdle(StreamingQueryListener):
    """Writes a bundle that got old while nothing more arrived."""

    def __init__(self, bundles: Bundles, query: str):
        self.bundles, self.query, self.id = bundles, query, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if event.id == self.id:
            self.bundles.flush(datetime.now(timezone.utc))

    def onQueryTerminated(self, event) -> None:
        if event.id == self.id:
            self.bundles.table.spark.streams.removeListener(self)

