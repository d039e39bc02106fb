"""Matroska files as a binary column: writing, and parsing into packet tables.

Reading follows the container: variable-length EBML ids and sizes (also elements of unknown
size), clusters with their base time, simple blocks and block groups, the four kinds of
lacing, and cues. A packet is one laced frame with its track, timestamp and byte range in
the file. Writing makes the same structure, with 8-bit samples as uncompressed packets.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, map_rows

# Element ids and lacing codes of the Matroska container.
EBML = 0x1A45DFA3
EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
MUXING_APP, WRITING_APP = 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
AUDIO, SAMPLE_RATE, CHANNELS, BIT_DEPTH, FLAG_LACING = 0xE1, 0xB5, 0x9F, 0x6264, 0x9C
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
PARENTS = frozenset({SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS})
TOP_LEVEL = frozenset({INFO, TRACKS, CLUSTER, CUES})
NO_LACING, XIPH_LACING, FIXED_LACING, EBML_LACING = 0, 1, 2, 3

SAMPLES = 576  # 8-bit samples of a packet
PACKETS_PER_BLOCK = 8
BLOCKS_PER_CLUSTER = 64  # at most; fewer where their times would not fit
LAST_RELATIVE = 32_767  # block times are signed 16-bit numbers, counted from their cluster's
RATE = 8000
PAD = b"\xff"


class Packet(NamedTuple):
    track: int
    timestamp: int
    keyframe: bool
    lacing: int
    frame: int  # place in its block
    start: int  # first byte in the file
    length: int


# ---- writing


def _size(n: int) -> bytes:
    """A length as EBML variable-length number; all ones are kept for "unknown"."""
    width = 1
    while n >= (1 << 7 * width) - 1:
        width += 1
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(code: int, body: bytes) -> bytes:
    return code.to_bytes((code.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _number(code: int, value: int) -> bytes:
    return _element(code, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], kind: int) -> bytes:
    """Lacing header and frames of a block."""
    if kind == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if kind == XIPH_LACING:
        for n in sizes[:-1]:
            head += b"\xff" * (n // 255) + bytes([n % 255])
    elif kind == EBML_LACING:
        head += _size(sizes[0])
        for last, n in zip(sizes, sizes[1:-1]):
            step, width = n - last, 1
            while not -(1 << 7 * width - 1) < step < (1 << 7 * width - 1):
                width += 1
            bias = (1 << 7 * width - 1) - 1
            head += (step + bias | 1 << 7 * width).to_bytes(width, "big")
    return head + b"".join(frames)


def block(track: int, relative: int, frames: list[bytes], kind: int, simple: bool = True) -> bytes:
    if len(frames) == 1:
        kind = NO_LACING
    if not -LAST_RELATIVE - 1 <= relative <= LAST_RELATIVE:
        raise ValueError(f"a block {relative} ms from its cluster")
    body = _size(track) + struct.pack(">hB", relative, (0x80 if simple else 0) | kind << 1) + lace(frames, kind)
    return _element(SIMPLE_BLOCK, body) if simple else _element(BLOCK_GROUP, _element(BLOCK, body))


def mux(payload: bytes, samples: int = SAMPLES) -> bytes:
    """A file with one track of 8-bit samples; ``payload`` is a multiple of ``samples``
    long. Timestamps count packets' milliseconds at the track's rate."""
    frame_ms = samples * 1000 // RATE
    head = _element(
        EBML,
        _number(EBML_MAX_ID, 4) + _number(EBML_MAX_SIZE, 8) + _element(DOC_TYPE, b"matroska") + _number(DOC_VERSION, 4) + _number(DOC_READ_VERSION, 2),
    )
    frames = len(payload) // samples
    info = _element(
        INFO,
        _number(TIMESTAMP_SCALE, 1_000_000)
        + _element(DURATION, struct.pack(">d", frames * frame_ms))
        + _element(MUXING_APP, b"tidemark")
        + _element(WRITING_APP, b"tidemark"),
    )
    audio = _element(SAMPLE_RATE, struct.pack(">d", RATE)) + _number(CHANNELS, 1) + _number(BIT_DEPTH, 8)
    tracks = _element(
        TRACKS,
        _element(
            TRACK_ENTRY,
            _number(TRACK_NUMBER, 1)
            + _number(TRACK_UID, 1)
            + _number(TRACK_TYPE, 2)
            + _number(FLAG_LACING, 1)
            + _element(CODEC_ID, b"A_PCM/INT/LIT")
            + _element(AUDIO, audio),
        ),
    )
    parts, position, cues = [info, tracks], len(info) + len(tracks), []
    # A cluster closes before the time of its next block would leave the range.
    fitting = 1 + LAST_RELATIVE // (PACKETS_PER_BLOCK * max(frame_ms, 1))
    per_cluster = min(BLOCKS_PER_CLUSTER, fitting) * PACKETS_PER_BLOCK
    for first in range(0, frames, per_cluster):
        blocks = [_number(CLUSTER_TIME, first * frame_ms)]
        last = min(first + per_cluster, frames)
        for at in range(first, last, PACKETS_PER_BLOCK):
            own = [payload[i * samples : (i + 1) * samples] for i in range(at, min(at + PACKETS_PER_BLOCK, last))]
            blocks.append(block(1, (at - first) * frame_ms, own, FIXED_LACING))
        cluster = _element(CLUSTER, b"".join(blocks))
        place = _element(CUE_POSITIONS, _number(CUE_TRACK, 1) + _number(CUE_CLUSTER, position))
        cues.append(_element(CUE_POINT, _number(CUE_TIME, first * frame_ms) + place))
        parts.append(cluster)
        position += len(cluster)
    parts.append(_element(CUES, b"".join(cues)))
    return head + _element(SEGMENT, b"".join(parts))


# ---- reading


def _id(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4:
        raise ValueError(f"no element id at byte {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def _vint(data: bytes, at: int) -> tuple[int, int, int]:
    """Value without its marker, end, width; all ones give -1 (unknown)."""
    width = 9 - data[at].bit_length()
    if width > 8 or at + width > len(data):
        raise ValueError(f"no length at byte {at}")
    value = int.from_bytes(data[at : at + width], "big") & (1 << 7 * width) - 1
    return (-1 if value == (1 << 7 * width) - 1 else value), at + width, width


def elements(data: bytes, at: int = 0, end: int | None = None, parent: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(id, parent id, body start, body end) depth first; returns the place reached. A
    cluster of unknown size ends where the next element of its own level begins; other
    bodies of unknown size end with their parent."""
    end = len(data) if end is None else end
    while at < end:
        code, body = _id(data, at)
        if parent == CLUSTER and code in TOP_LEVEL:
            return at
        size, body, _ = _vint(data, body)
        stop = end if size < 0 else body + size
        if stop > end:
            raise ValueError(f"element {code:x} at byte {at} runs over its parent")
        yield code, parent, body, stop
        reached = stop
        if code in PARENTS:
            reached = yield from elements(data, body, stop, code)
        at = reached if size < 0 else stop
    return at


def unlace(data: bytes, at: int, end: int, kind: int) -> list[tuple[int, int]]:
    """(start, length) of every frame of a block body after its flags."""
    if kind == NO_LACING:
        return [(at, end - at)]
    count = data[at] + 1
    at += 1
    sizes: list[int] = []
    if kind == FIXED_LACING:
        sizes = [(end - at) // count] * (count - 1)
    elif kind == XIPH_LACING:
        for _ in range(count - 1):
            total = 0
            while data[at] == 255:
                total += 255
                at += 1
            sizes.append(total + data[at])
            at += 1
    elif count > 1:
        first, at, _ = _vint(data, at)
        sizes.append(first)
        for _ in range(count - 2):
            width = 9 - data[at].bit_length()
            raw = int.from_bytes(data[at : at + width], "big") & (1 << 7 * width) - 1
            sizes.append(sizes[-1] + raw - ((1 << 7 * width - 1) - 1))
            at += width
    frames = []
    for n in sizes:
        frames.append((at, n))
        at += n
    if at > end:
        raise ValueError("laced frames run over their block")
    return [*frames, (at, end - at)]


class Parsed(NamedTuple):
    packets: list[Packet]
    cues: list[tuple[int, int, int]]  # time, track, byte of the cluster in the file
    scale: int
    tracks: list[int]
    clusters: int


def parse(data: bytes) -> Parsed:
    """Packet table and cues of a file. Raises ValueError where the structure is broken."""
    packets: list[Packet] = []
    cues: list[tuple[int, int, int]] = []
    tracks: list[int] = []
    base = time = track = segment = clusters = 0
    scale = 1_000_000

    def value(a: int, b: int) -> int:
        return int.from_bytes(data[a:b], "big")

    for code, parent, body, stop in elements(data):
        if code in (SIMPLE_BLOCK, BLOCK):
            number, at, _ = _vint(data, body)
            relative, flags = struct.unpack_from(">hB", data, at)
            kind = flags >> 1 & 3
            for i, (start, length) in enumerate(unlace(data, at + 3, stop, kind)):
                packets.append(Packet(number, base + relative, code == SIMPLE_BLOCK and flags >= 128, kind, i, start, length))
        elif code == CLUSTER_TIME:
            base = value(body, stop)
        elif code == CLUSTER:
            clusters += 1
        elif code == SEGMENT:
            segment = body
        elif code == TIMESTAMP_SCALE:
            scale = value(body, stop)
        elif code == TRACK_NUMBER:
            tracks.append(value(body, stop))
        elif code == CUE_TIME:
            time = value(body, stop)
        elif code == CUE_TRACK:
            track = value(body, stop)
        elif code == CUE_CLUSTER:
            cues.append((time, track, segment + value(body, stop)))
    return Parsed(packets, cues, scale, tracks, clusters)


# ---- columns


def media_column(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``media``: every whole text, padded with bytes 255 to a
    positive multiple of 576, as a Matroska file. A null text counts as empty."""

    def run(ids, texts):
        raw = [(t or "").encode() for t in texts]
        return {id_col: ids, "n_bytes": [len(r) for r in raw], "media": [mux(padded(r)) for r in raw]}

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], run, f"{id_col} {kind}, n_bytes long, media binary")


def padded(raw: bytes) -> bytes:
    return raw + PAD * (-len(raw) % SAMPLES or (0 if raw else SAMPLES))


def packet_table(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per packet of a binary column: id, track, timestamp in nanoseconds, keyframe,
    lacing, place in the block, first byte and length. Null media give no rows; media that
    cannot be parsed give one row whose ``error`` says why."""

    def run(ids, media):
        rows: dict[str, list] = {c: [] for c in (id_col, *Packet._fields, "error")}
        for key, data in zip(ids, media):
            if data is None:
                continue
            try:
                parsed = parse(data)
                found = [p._replace(timestamp=p.timestamp * parsed.scale) for p in parsed.packets]
                errors = [None] * len(found)
            except (ValueError, IndexError, struct.error) as error:
                found, errors = [Packet(*[None] * len(Packet._fields))], [str(error)]
            rows[id_col] += [key] * len(found)
            rows["error"] += errors
            for name, column in zip(Packet._fields, zip(*found)):
                rows[name] += column
        return rows

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, track long, timestamp long, keyframe boolean, lacing int, frame int, start long, length long, error string"
    return map_rows(df, [id_col, media_col], run, schema)


def media_digest(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Read media back: payload of all packets in time order, digests, and a feature text
    (packets, clusters, cues that hit a packet's time, duration in milliseconds, levels).
    ``levels`` are the shares in thousandths of sample values below 64, 128 and 192."""

    def run(ids, sizes, media):
        rows: dict[str, list] = {c: [] for c in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for data in media:
            parsed = parse(data)
            packets = parsed.packets
            payload = b"".join([data[p.start : p.start + p.length] for p in packets])
            times = {p.timestamp for p in packets if not p.frame}
            hits = sum(time in times for time, _, _ in parsed.cues)
            counts = np.bincount(np.frombuffer(payload, np.uint8) >> 6, minlength=4)
            levels = np.cumsum(counts)[:3] * 1000 // len(payload)
            duration = len(packets) * SAMPLES * 1000 // RATE
            rows["payload_bytes"].append(len(payload))
            rows["payload_sha256"].append(hashlib.sha256(payload).hexdigest())
            rows["tail_crc32"].append(zlib.crc32(payload[-32:]))
            rows["media_bytes"].append(len(data))
            rows["media_sha256"].append(hashlib.sha256(data).hexdigest())
            rows["feature"].append(
                f"packets={len(packets)};clusters={parsed.clusters};cues={hits};ms={duration};levels={','.join(map(str, levels))}"
            )
        return {id_col: ids, "n_bytes": sizes, **rows}

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_rows(df.where(F.col(media_col).isNotNull()), [id_col, "n_bytes", media_col], run, schema)


def op6_media_columns(spark, directory):
    """Every document stored as Matroska and read back.

    Narrow: one row in, one row out, no exchange; memory is bounded by a batch of texts.
    Null and empty texts are one packet of padding; equal texts give equal values; ids may
    be null or repeated; an empty table gives no rows; other columns are ignored.
    """
    return media_digest(media_column(load(spark, directory, "documents")))


QUERIES = {"op6_media_columns": op6_media_columns}
ORACLES: dict[str, str] = {}
