"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding some records, and a footer
in a skippable frame: the seek table with the compressed and plain length of every frame.
An index maps record ids to (bundle, frame, offset inside the plain frame). Bundles are
kept as a binary column of a written table, so any store that Spark reads and writes will
do, and a lost executor costs one task.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from typing import NamedTuple

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, load, written

# Magic numbers of skippable frames and of the seek table's footer.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 256 << 10  # plain bytes after which a frame is closed
BUNDLE_BYTES = 8 << 20  # plain bytes after which a bundle is closed
LEVEL = 3
CAPTURE_TIME = "2024-01-01T00:00:00Z"

INDEX = "index array<struct<record_id:string,frame:int,offset:long,length:long>>"
BUNDLES = f"bundle_id string, archive binary, {INDEX}"
RECORDS = "record_id string, record_type string, refers_to string, url string, payload_bytes long, payload_digest string"


class Record(NamedTuple):
    record_id: str
    record_type: str
    refers_to: str | None
    url: str
    payload_bytes: int
    payload_digest: str
    payload: bytes | None  # None for a revisit


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(record_id: str) -> str:
    return f"<urn:page:{record_id}>"


def _plain(urn: str) -> str:
    return urn[len("<urn:page:") : -1]


def encode_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record. A revisit keeps the HTTP head, whose length is that of the full payload,
    and the payload's digest, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    uri = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {_urn(record_id)}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {CAPTURE_TIME}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(4, f"WARC-Refers-To: {_urn(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, value in pairs}


def decode_record(plain: bytes, at: int = 0) -> tuple[Record, int]:
    """The record at ``at`` and the place of the next. Raises where a response's payload
    does not have the length and digest that its record states."""
    end = plain.index(b"\r\n\r\n", at)
    fields = _fields(plain[at:end])
    body = end + 4
    stop = body + int(fields["content-length"])
    http_end = plain.index(b"\r\n\r\n", body)
    http = _fields(plain[body:http_end])
    revisit = fields["warc-type"] == "revisit"
    payload = None if revisit else plain[http_end + 4 : stop]
    size, digest = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    if payload is not None and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    refers = fields.get("warc-refers-to")
    record = Record(
        _plain(fields["warc-record-id"]), fields["warc-type"], refers and _plain(refers), fields["warc-target-uri"], size, digest, payload
    )
    return record, stop + 4


class BundleWriter:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, level: int = LEVEL):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.parts: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.open: list[bytes] = []
        self.filled = self.total = 0

    def add(self, record_id: str, record: bytes) -> None:
        self.index.append({"record_id": record_id, "frame": len(self.table), "offset": self.filled, "length": len(record)})
        self.open.append(record)
        self.filled += len(record)
        self.total += len(record)
        if self.filled >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            frame = self.pack(b"".join(self.open))
            self.parts.append(frame)
            self.table.append((len(frame), self.filled))
            self.open, self.filled = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        head = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer))
        return b"".join(self.parts) + head + entries + footer


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed length, plain length) of every frame, from the footer."""
    count, flags, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, start, frames = len(archive) - 9 - width * count, 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", archive, at + width * i)
        frames.append((start, packed, plain))
        start += packed
    return frames


def read_frame(archive: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    start, packed, plain = frame
    return zstandard.ZstdDecompressor().decompress(archive[start : start + packed], max_output_size=plain)


def with_originals(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``record_id``, ``url``, ``payload`` and ``original``: for every record that repeats
    the payload of a smaller id, that smallest id, else null.

    Payloads are compared by SHA-256 and length. Only payloads that occur more than once
    reach the join, whose large side adaptive execution can split at a hot payload.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    keyed = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("content"),
        F.octet_length(payload).alias("size"),
    )
    repeated = (
        keyed.groupBy("content", "size")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("content", "size", "first_id")
    )
    repeated = written(repeated, "repeated-payloads")
    original = F.when(~F.col("id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return keyed.join(repeated, ["content", "size"], "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("record_id"),
        "url",
        "payload",
        original.cast("string").alias("original"),
    )


def write_bundles(records: DataFrame) -> DataFrame:
    """Bundles of ``with_originals`` as a written table: ``bundle_id``, ``archive``, ``index``."""
    target = arrow_schema(BUNDLES, records.sparkSession)

    def run(batches):
        import pyarrow as pa

        part, number, writer = TaskContext.get().partitionId(), 0, BundleWriter()

        def bundle():
            rows = {"bundle_id": [f"{part:06d}-{number:06d}"], "archive": [writer.finish()], "index": [writer.index]}
            return pa.RecordBatch.from_pydict(rows, schema=target)

        for batch in batches:
            for key, url, payload, original in zip(*(c.to_pylist() for c in batch.columns)):
                writer.add(key, encode_record(key, url, payload.encode(), original))
                if writer.total >= BUNDLE_BYTES:
                    yield bundle()
                    number, writer = number + 1, BundleWriter()
        if writer.total:
            yield bundle()

    return written(records.select("record_id", "url", "payload", "original").mapInArrow(run, BUNDLES), "bundles")


def record_index(bundles: DataFrame) -> DataFrame:
    """``record_id``, ``bundle_id``, ``frame``, ``offset``, ``length`` of every record."""
    return bundles.select("bundle_id", F.explode("index").alias("at")).select("at.record_id", "bundle_id", "at.frame", "at.offset", "at.length")


def _records(bundles: DataFrame, columns: list[str], visit, payload: bool) -> DataFrame:
    schema = RECORDS + (", payload binary" if payload else "")
    target = arrow_schema(schema, bundles.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for records in visit(*row):
                    yield pa.RecordBatch.from_pylist([r._asdict() for r in records], schema=target)

    return bundles.select(*columns).mapInArrow(run, schema)


def read_bundles(bundles: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of every bundle, frame by frame."""

    def visit(archive):
        for frame in seek_table(archive):
            plain, at, out = read_frame(archive, frame), 0, []
            while at < len(plain):
                record, at = decode_record(plain, at)
                out.append(record)
            yield out

    return _records(bundles, ["archive"], visit, payload)


def lookup(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose ids are in ``wanted.record_id``; only their frames are unpacked."""
    places = (
        record_index(bundles)
        .join(wanted.select("record_id").distinct(), "record_id", "left_semi")
        .groupBy("bundle_id")
        .agg(F.collect_list(F.struct("frame", "offset")).alias("places"))  # at most one bundle's records
    )

    def visit(archive, places):
        frames, plain = seek_table(archive), {}
        for place in places:
            if place["frame"] not in plain:
                plain[place["frame"]] = read_frame(archive, frames[place["frame"]])
            yield [decode_record(plain[place["frame"]], place["offset"])[0]]

    return _records(bundles.select("bundle_id", "archive").join(places, "bundle_id"), ["archive", "places"], visit, True)


def archive_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Write every page to bundles and read them back: ``id_col``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``.

    Null html is an empty payload; empty payloads take part like others. Of equal payloads
    the row with the smallest id is the response; rows that repeat that id are responses
    too; a null id is larger than any other, and payloads of null ids only are responses.
    An empty table gives no rows; other columns are ignored.
    """
    kind = pages.schema[id_col].dataType
    records = read_bundles(write_bundles(with_originals(pages, id_col, html_col, url_col)), payload=False)
    return records.select(
        F.when(F.col("record_id") != "null", F.col("record_id")).cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op7_warc(spark, directory):
    """Every page written to WARC bundles and read back."""
    return archive_pages(load(spark, directory, "pages"))


QUERIES = {"op7_warc": op7_warc}

ORACLES = {
    "op7_warc": """
SELECT page_id,
       octet_length(encode(payload)) AS payload_bytes,
       array_to_string(list_transform(range(0, 40, 5), lambda i: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(payload), i + 1, 5))::BIGINT >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages) p
"""
}
