"""Repeated byte strings of 50 bytes and more, by sorted suffixes.

Every 50-byte window names one of its 16-byte strings, the one with the least hash, as its
anchor, so equal windows anywhere have the same anchor at the same place. Of the 34 other
bytes at least 17 lie on one side of it; the anchor with these is the window's key. That
splits the suffixes of the corpus into classes that can be sorted apart, and most keys occur
in one document only and drop out before any text moves:

1. every block of documents sends the hashes of its keys to their buckets;
2. a bucket answers, for every block, which of them occur in two documents;
3. a block sends the text around those keys, equal text once, with its smallest id;
4. a bucket sorts the windows of equal keys and answers the smallest id of each;
5. a block removes the windows that a smaller id has.

Sorting is deep-shallow: multikey quicksort by machine words to a shallow depth, then blind
tries for the windows whose common prefix is longer. Blocks and buckets have bounded sizes,
and a string in a third of all documents reaches its bucket once a block.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import load, mix

WINDOW = 50
ANCHOR = 16
GRAMS = WINDOW - ANCHOR + 1  # anchors a window can choose from
SHALLOW_WORDS = 2  # 8-byte words that are sorted before blind tries begin
SIDE = (WINDOW - ANCHOR) // 2  # bytes beside the anchor that a key has, one more on the left
KEY = ANCHOR + SIDE + 1
CONTEXT = WINDOW + SIDE  # longest text whose windows share a key
ROW = CONTEXT + 4  # a context with its anchor place and window count
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
SEGMENT = 1 << 20
PLACE_BITS = np.uint64((1 << 24) - 1)
BLOCK = "_repeats_block"  # column that deals documents out
NO_ID = np.iinfo(np.int64).max

ANSWERS = "block int, kind int, bucket int, bits binary, extra binary"


# ---- suffix sorting


def equal_windows(texts: np.ndarray, groups: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort windows and find the equal ones.

    ``texts`` is a flat byte array, ``starts`` the first byte of every window, ``groups`` a
    number that equal windows share. Returns the indexes of the windows that are equal to
    another one, in sorted order, and a class number for each of them.
    """
    words = _words(texts)
    alive = np.arange(len(starts))
    rank = groups.astype(np.int64)
    for depth in range(SHALLOW_WORDS):
        key = words[starts[alive] + 8 * depth]
        order = np.lexsort((key, rank))
        alive, key, rank = alive[order], key[order], rank[order]
        new = np.ones(len(alive), bool)
        new[1:] = (key[1:] != key[:-1]) | (rank[1:] != rank[:-1])
        rank = np.cumsum(new)
        single = new & np.append(new[1:], True)
        alive, rank = alive[~single], rank[~single]
    found, classes = [], []
    number = 0
    raw = texts.tobytes()
    edges = np.flatnonzero(np.diff(rank, prepend=-1, append=-1)) if len(rank) else np.zeros(1, np.int64)
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = alive[first:last].tolist()
        tails = [raw[s + 8 * SHALLOW_WORDS : s + WINDOW] for s in starts[own].tolist()]
        for members in blind_trie(tails):
            if len(members) > 1:
                found += [own[m] for m in members]
                classes += [number] * len(members)
                number += 1
    return np.array(found, np.int64), np.array(classes, np.int64)


def _words(texts: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on, as one big-endian number."""
    out = np.append(texts, np.zeros(8, np.uint8)).astype(np.uint64)
    for span in (1, 2, 4):
        out = (out[:-span] << np.uint64(8 * span)) | out[span:]
    return out


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Indexes of equal strings together, in lexicographic order; all of one length.

    Inner nodes hold only the place at which their strings first differ. A string goes down
    by the bytes at those places without looking at the others; one comparison with any
    string below then tells where it really leaves the path.
    """
    width = len(strings[0])
    root: list = [width, [0]]  # a leaf: [width, indexes]; a node: [place, {byte: child}]
    for i in range(1, len(strings)):
        text, node = strings[i], root
        while node[0] < width:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        if text == other:
            node[1].append(i)
            continue
        differs = int.from_bytes(text, "big") ^ int.from_bytes(other, "big")
        place = width - (differs.bit_length() + 7) // 8
        node = root
        while node[0] < place:
            node = node[1][text[node[0]]]
        if node[0] == place:
            node[1][text[place]] = [width, [i]]
        else:
            node[:] = [place, {text[place]: [width, [i]], other[place]: [node[0], node[1]]}]
    out: list[list[int]] = []
    open_ = [root]
    while open_:
        node = open_.pop()
        if node[0] == width:
            out.append(node[1])
        else:
            open_ += [node[1][byte] for byte in sorted(node[1], reverse=True)]
    return out


# ---- blocks


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every run of ``span`` values."""
    reach = 1
    while reach * 2 <= span:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (span - reach)], values[span - reach :]) if span > reach else values


def anchor_runs(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key: first window, number of windows, anchor's place and the
    key's hash. ``begins`` are the texts' first bytes in ``data`` and its length. Long data
    is cut into segments that overlap by a window."""
    parts = []
    last_start = len(data) - WINDOW
    text_end = begins[1:]
    for low in range(0, last_start + 1, SEGMENT):
        piece = data[low : low + SEGMENT + WINDOW - 1]
        grams = _words(piece)[: len(piece) - 7]
        hashes = mix(grams[: len(piece) - ANCHOR + 1] ^ mix(grams[8:] * np.uint64(0x9E3779B97F4A7C15)))
        ranked = (hashes & ~PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        owner = (_least(ranked, GRAMS) & PLACE_BITS).astype(np.int64)
        start = np.arange(low, low + len(owner))
        # A window must end inside its text.
        inside = np.ones(len(owner), bool)
        for end in text_end[np.searchsorted(text_end, low) : np.searchsorted(text_end, low + len(piece)) + 1].tolist():
            inside[max(0, end - WINDOW + 1 - low) : max(0, end - low)] = False
        start, owner = start[inside], owner[inside]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(owner)))
        begin, anchor = start[first], owner[first] + low
        # Windows with more than SIDE bytes before their anchor come first.
        left = np.clip(anchor - begin - SIDE, 0, count)
        for begins_at, size, at, reach in ((begin, left, anchor - SIDE - 1, SIDE + 1), (begin + left, count - left, anchor, SIDE)):
            some = size > 0
            key = np.full(int(some.sum()), reach, np.uint64)
            for step in (0, 8, 16, 24, ANCHOR + reach - 8):
                key = mix(key ^ grams[at[some] - low + step])
            parts.append((begins_at[some], size[some], anchor[some], key))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(columns) for columns in zip(*parts))


class Block:
    """Documents of one block in the order of their ids, and their anchors."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, buckets: int):
        pa.default_memory_pool().release_unused()
        ids = table[id_col].cast(pa.int64()).fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        texts = [(t or "").encode() for t in self.table[text_col].to_pylist()]
        self.begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.first, self.count, self.place, keys = anchor_runs(self.data, self.begins)
        self.doc = np.searchsorted(self.begins, self.first, side="right") - 1
        self.keys, self.key_of = np.unique(keys, return_inverse=True)
        bucket = (self.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def in_two_documents(self) -> np.ndarray:
        low = np.full(len(self.keys), NO_ID)
        high = np.full(len(self.keys), -1)
        np.minimum.at(low, self.key_of, self.ids[self.doc])
        np.maximum.at(high, self.key_of, self.ids[self.doc])
        return low != high

    def contexts(self, answers: list[tuple[int, bytes]]):
        """Text around the anchors that occur twice: distinct rows, the smallest id of
        each, the bucket of each, and (run, row) of every such anchor."""
        twice = np.zeros(len(self.keys), bool)
        for bucket, bits in answers:
            a, b = self.cuts[bucket], self.cuts[bucket + 1]
            twice[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8))[: b - a]
        runs = np.flatnonzero(twice[self.key_of])
        rows = np.zeros((len(runs), ROW), np.uint8)
        size = self.count[runs] + WINDOW - 1
        rows[:, 0] = self.place[runs] - self.first[runs]
        rows[:, 1] = self.count[runs]
        at = np.arange(CONTEXT)
        for low in range(0, len(runs), 1 << 13):
            part = runs[low : low + (1 << 13)]
            where = np.minimum(self.first[part, None] + at, len(self.data) - 1)
            rows[low : low + len(part), 4:] = np.where(at < size[low : low + len(part), None], self.data[where], 0)
        if not len(runs):
            return rows, np.empty(0, np.int64), np.empty(0, np.int64), runs, runs
        _, sample, row_of = np.unique(rows.view(f"V{ROW}").ravel(), return_index=True, return_inverse=True)
        bucket = np.searchsorted(self.cuts, self.key_of[runs[sample]], side="right") - 1
        by_bucket = np.argsort(bucket, kind="stable")
        position = np.empty(len(by_bucket), np.int64)
        position[by_bucket] = np.arange(len(by_bucket))
        sample = sample[by_bucket]
        return rows[sample], self.ids[self.doc[runs[sample]]], bucket[by_bucket], runs, position[row_of]


def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(raw, "<i8", len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


MESSAGES = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("bits", pa.binary())])
REPLIES = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary()), ("extra", pa.binary())])


def _anchor_messages(id_col: str, text_col: str, buckets: int):
    def send(key, table):
        block = Block(table, id_col, text_col, buckets)
        both = block.in_two_documents()
        low = np.ascontiguousarray(block.keys.view(np.uint8).reshape(-1, 8)[:, :6])
        filled = np.flatnonzero(np.diff(block.cuts)).tolist()
        spans = [(block.cuts[b], block.cuts[b + 1]) for b in filled]
        return _table(
            MESSAGES,
            filled,
            [key[0].as_py()] * len(filled),
            [low[a:b].tobytes() for a, b in spans],
            [np.packbits(both[a:b]).tobytes() for a, b in spans],
        )

    return send


def _repeated_anchors(key, table):
    """Which anchors of every block occur in two documents."""
    blocks = table["block"].to_pylist()
    lists = [np.frombuffer(k, np.uint8).reshape(-1, 6) for k in table["keys"].to_pylist()]
    both = [np.unpackbits(np.frombuffer(b, np.uint8))[: len(k)] for b, k in zip(table["bits"].to_pylist(), lists)]
    wide = np.zeros((sum(map(len, lists)), 8), np.uint8)
    wide[:, :6] = np.concatenate(lists)
    keys = wide.view(np.uint64).ravel()
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    several = np.diff(np.append(first, len(keys))) > 1
    several |= np.maximum.reduceat(np.concatenate(both)[order], first) > 0
    twice = np.empty(len(keys), bool)
    twice[order] = several[np.cumsum(new) - 1]
    cuts = np.cumsum([0, *map(len, lists)])
    spans = [(b, twice[a:z]) for b, a, z in zip(blocks, cuts, cuts[1:])]
    spans = [(b, t) for b, t in spans if t.any()]
    n = len(spans)
    return _table(REPLIES, [b for b, _ in spans], [0] * n, [key[0].as_py()] * n, [np.packbits(t).tobytes() for _, t in spans], [None] * n)


def _context_messages(id_col: str, text_col: str, buckets: int):
    def send(key, table, answers):
        if not table.num_rows or not answers.num_rows:
            return _table(MESSAGES, [], [], [], [])
        block = Block(table, id_col, text_col, buckets)
        rows, ids, bucket, _, _ = block.contexts(list(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist())))
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        filled = np.flatnonzero(np.diff(cuts)).tolist()
        blobs = [_packed(rows[cuts[b] : cuts[b + 1]], ids[cuts[b] : cuts[b + 1]]) for b in filled]
        return _table(MESSAGES, filled, [key[0].as_py()] * len(filled), blobs, [None] * len(filled))

    return send


def smallest_owners(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For contexts ``rows`` with ids: the distinct context of each, the smallest id of each
    distinct context, and (context, window, id) where a window of another context that is
    equal has a smaller id still."""
    _, sample, distinct = np.unique(rows.view(f"V{ROW}").ravel(), return_index=True, return_inverse=True)
    least = np.full(len(sample), NO_ID)
    np.minimum.at(least, distinct, ids)
    own = rows[sample]
    place, count = own[:, 0].astype(np.int64), own[:, 1].astype(np.int64)
    left = place > SIDE
    keys = own[np.arange(len(own))[:, None], 4 + np.where(left, place - SIDE - 1, place)[:, None] + np.arange(KEY)]
    keys[~left, -1] = 0  # on the right a key is one byte shorter
    _, group, size = np.unique(np.ascontiguousarray(keys).view(f"V{KEY}").ravel(), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(size[group] > 1)
    shared = shared[np.argsort(group[shared], kind="stable")]
    out: list[tuple[np.ndarray, ...]] = []
    # Whole groups at a time, some ten thousand contexts together.
    ends = np.flatnonzero(np.diff(group[shared], append=-1)) + 1
    low = 0
    while low < len(shared):
        high = int(ends[min(np.searchsorted(ends, low + 20_000), len(ends) - 1)])
        part = shared[low:high]
        context = np.repeat(np.arange(len(part)), count[part])
        window = np.arange(len(context)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        numbers = group[part][context] * WINDOW + place[part][context] - window
        found, classes = equal_windows(own[part].ravel(), numbers, context * ROW + 4 + window)
        if len(found):
            best = np.full(classes[-1] + 1, NO_ID)
            mine = least[part[context[found]]]
            np.minimum.at(best, classes, mine)
            less = best[classes] < mine
            out.append((part[context[found]][less], window[found][less], best[classes][less]))
        low = high
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
    return distinct, least, *columns


def _window_owners(key, table):
    blocks = table["block"].to_pylist()
    parts = [_unpacked(blob, np.uint8, np.int64) for blob in table["keys"].to_pylist()]
    rows = np.concatenate([r for r, _ in parts]).reshape(-1, ROW)
    distinct, least, context, window, better = smallest_owners(rows, np.concatenate([i for _, i in parts]))
    order = np.argsort(context, kind="stable")
    context, window, better = context[order], window[order], better[order]
    cuts = np.cumsum([0, *(len(i) for _, i in parts)])
    replies = []
    for a, z in zip(cuts, cuts[1:]):
        own = distinct[a:z]
        first, last = np.searchsorted(context, own), np.searchsorted(context, own, side="right")
        counts = last - first
        at = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        replies.append((_packed(least[own]), _packed(np.repeat(np.arange(len(own)), counts), window[at], better[at])))
    n = len(blocks)
    return _table(REPLIES, blocks, [1] * n, [key[0].as_py()] * n, [r[0] for r in replies], [r[1] for r in replies])


def _removal(id_col: str, text_col: str, buckets: int, with_text: bool, target: pa.Schema):
    def remove(key, table, answers):
        block = Block(table, id_col, text_col, buckets)
        starts = np.zeros(len(block.data) + 1, bool)
        kinds, where = answers["kind"].to_pylist(), answers["bucket"].to_pylist()
        bits, extra = answers["bits"].to_pylist(), answers["extra"].to_pylist()
        twice = [(b, x) for k, b, x in zip(kinds, where, bits) if k == 0]
        if twice and len(block.keys):
            rows, _, bucket, runs, row_of = block.contexts(twice)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            least = np.full(len(rows), NO_ID)
            better: list[tuple[np.ndarray, ...]] = []
            for k, b, x, more in zip(kinds, where, bits, extra):
                if k == 1:
                    least[cuts[b] : cuts[b + 1]] = _unpacked(x, np.int64)[0]
                    row, window, smaller = _unpacked(more, np.int64, np.int64, np.int64)
                    better.append((row + cuts[b], window, smaller))
            mine = block.ids[block.doc[runs]]
            for run in runs[least[row_of] < mine].tolist():
                starts[block.first[run] : block.first[run] + block.count[run]] = True
            row, window, smaller = (np.concatenate(c) for c in zip(*better))
            if len(row):
                # The windows of a row in every run that has that row.
                order = np.argsort(row_of, kind="stable")
                ordered = row_of[order]
                first, last = np.searchsorted(ordered, row), np.searchsorted(ordered, row, side="right")
                counts = last - first
                at = order[np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
                hit = np.repeat(smaller, counts) < mine[at]
                starts[block.first[runs[at]][hit] + np.repeat(window, counts)[hit]] = True
        return pa.Table.from_arrays(_rows(block, starts[:-1], with_text, text_col), schema=target)

    return remove


def _rows(block: Block, starts: np.ndarray, with_text: bool, text_col: str) -> list[pa.Array]:
    """Output columns of a block from the places where removed windows begin."""
    seen = np.cumsum(starts, dtype=np.int32)
    covered = seen > 0
    covered[WINDOW:] = seen[WINDOW:] > seen[:-WINDOW]
    removed, spans, digests, texts = [], [], [], []
    for a, z in zip(block.begins[:-1].tolist(), block.begins[1:].tolist()):
        gone, own = covered[a:z], block.data[a:z]
        n = int(gone.sum())
        if with_text and n:
            # A character stays whole: it goes only if all of its bytes go.
            head = np.flatnonzero((own & 0xC0) != 0x80)
            gone = np.repeat(np.minimum.reduceat(gone, head), np.diff(np.append(head, len(own))))
        kept = own[~gone].tobytes() if n else own.tobytes()
        removed.append(n)
        spans.append(int(np.count_nonzero(np.diff(covered[a:z].astype(np.int8), prepend=0) == 1)))
        digests.append(hashlib.sha256(kept).hexdigest())
        texts.append(kept.decode() if with_text and n else None)
    table = block.table
    if with_text:
        old = table[text_col].to_pylist()
        table = table.set_column(table.schema.get_field_index(text_col), text_col, pa.array([o if t is None else t for o, t in zip(old, texts)], pa.string()))
    table = table.drop_columns([BLOCK])
    sizes = np.diff(block.begins)
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
    return [*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, prefix: str = ""
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``: every byte
    goes that is covered by a 50-byte string which also starts in a document with a smaller
    id. With ``with_text`` the text column is what is kept, in whole characters (the digest
    then is that text's). ``prefix`` goes before the new names; columns so named in ``docs``
    are replaced.

    Null texts count as empty and stay null. A null id is larger than any other. Rows of one
    id are one document for the comparison: they do not remove each other. An empty table
    gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = [prefix + name for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256")]
    docs = docs.drop(*added)
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(total / BLOCK_BYTES), min(partitions, math.ceil(total / SEGMENT)))
    buckets = max(1, math.ceil(total / BUCKET_BYTES), min(partitions, math.ceil(total / SEGMENT)))
    block = F.pmod(F.xxhash64(F.col(id_col), text), F.lit(blocks)).cast("int")
    dealt = docs.withColumn(BLOCK, block)
    schema = T.StructType([*docs.schema.fields])
    for name in added[:-1]:
        schema = schema.add(name, "long")
    schema = schema.add(added[-1], "string")

    messages = "bucket int, block int, keys binary, bits binary"
    anchors = dealt.groupBy(BLOCK).applyInArrow(_anchor_messages(id_col, text_col, buckets), messages)
    repeated = anchors.groupBy("bucket").applyInArrow(_repeated_anchors, ANSWERS)
    contexts = (
        dealt.groupBy(BLOCK).cogroup(repeated.groupBy("block")).applyInArrow(_context_messages(id_col, text_col, buckets), messages)
    )
    owners = contexts.groupBy("bucket").applyInArrow(_window_owners, ANSWERS)
    remove = _removal(id_col, text_col, buckets, with_text, to_arrow_schema(schema))
    return dealt.groupBy(BLOCK).cogroup(repeated.union(owners).groupBy("block")).applyInArrow(remove, schema)


def op1_suffix_dedup(spark, directory):
    """Repeated 50-byte strings of all documents, removed from the larger ids."""
    docs = load(spark, directory, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}

ORACLES = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100) x),
first_of AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING count(*) > 1),
gone AS (SELECT doc_id, i FROM w JOIN first_of USING (s) WHERE first_id < doc_id),
island AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS n
           FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM gone) x),
span AS (SELECT doc_id, n, min(i) AS a, max(i) + 50 AS z FROM island GROUP BY doc_id, n),
piece AS (SELECT doc_id, n, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY n) AS before FROM span),
total AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last_z FROM span GROUP BY doc_id),
kept AS (SELECT p.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY n) AS k FROM piece p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last_z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
}
