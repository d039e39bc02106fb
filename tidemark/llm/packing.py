"""Training sequences by Karmarkar-Karp multiway differencing.

Documents become token ids and are cut into pieces: whole windows first, then the rest in
pieces of a bounded length. The pieces of a block of documents are dealt into windows by
largest differencing: every piece starts as a partial partition of its own, and the two
partitions with the largest spread merge, the fullest window of one with the emptiest of
the other. The windows come out nearly equal; if one is over capacity, the count rises.
Blocks are runs of rows of a scan task, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from operator import itemgetter

from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_schema, load

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
CAPACITY = 4096
# The rest of a document is cut at this length, so that differencing has small pieces too.
PIECE = 1024
BLOCK_TOKENS = 1 << 20  # rests that are packed together
REMEMBERED_WORDS = 700_000

SCHEMA = (
    "{id} {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by the tokenizer's own result
    for every blank-separated part. No step of this tokenizer looks over a blank: blanks
    are dropped, a letter after one starts a new word, and marks that compose or case rules
    do not reach over it. Letters and digits do not meet the signs after them either.

    A word of Latin letters goes to the tokenizer's model at once, as the lower-case,
    byte-level word that its first steps would make of it; other parts take all steps."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.merge = whole.model.tokenize
        self.encode = whole.encode
        self.known: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        if LATIN_WORD(piece):
            word = piece.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
            return array("I", [t.id for t in self.merge(word)]).tobytes()
        return array("I", self.encode(piece, add_special_tokens=False).ids).tobytes()

    def _learn(self, part: str) -> bytes:
        known = self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        match = SIGNS_AFTER_WORD(part)
        if match is None:
            found = known[part] = self._ids(part)
            return found
        found = b""
        for piece in match.groups():
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = self._ids(piece)
            found += ids
        known[part] = found
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        known, learn, out = self.known, self._learn, []
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            found = [*map(known.get, parts)]
            if None in found:
                found = [learn(part) if ids is None else ids for ids, part in zip(found, parts)]
            out.append(b"".join(found))
        return out


# Latin letters or digits, then signs that no rule of the tokenizer joins to them (no
# apostrophe, and no "<" that could begin a special string).
SIGNS_AFTER_WORD = re.compile(r"([0-9A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]+)").fullmatch
# Letters that case and composition rules take one by one.
LATIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
# The byte-level alphabet shows these bytes as the letters after 255, in order.
BYTE_LETTERS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
_TOKENIZERS: dict[str, WordIds] = {}


def tokenizer(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Largest differencing: indexes of ``sizes`` in ``windows`` groups of near equal sums.

    A partial partition lists its used windows in falling order of what they hold over its
    emptiest window; unused windows follow unwritten, at 0. Equal spreads merge by age.
    """
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    age = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # The fullest of a meets the emptiest of b: only where both are used do they add up.
        shared = max(0, len(a) + len(b) - windows)
        free_a, free_b = len(a) - shared, len(b) - shared
        merged = a[:free_a] + b[:free_b]
        merged += [(x + y, (m, n)) for (x, m), (y, n) in zip(a[free_a:], reversed(b[free_b:]))]
        merged.sort(key=FULL, reverse=True)
        low = merged[-1][0] if len(merged) == windows else 0
        if low:
            merged = [(size - low, own) for size, own in merged]
        heapq.heappush(heap, (-merged[0][0], age, merged))
        age += 1
    return [_members(own) for _, own in heap[0][2]]


FULL = itemgetter(0)


def _members(tree) -> list[int]:
    out, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_ += node
        else:
            out.append(node)
    return out


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Groups of indexes whose sums fit ``capacity``: differencing over as few windows as
    the total allows; while a window is over capacity the count rises."""
    if not sizes:
        return []
    total = sum(sizes)
    windows = -(-total // capacity)
    while True:
        groups = difference(sizes, windows)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return groups
        windows += max(1, windows // 200)


class BlockPacker:
    """Collects the pieces of documents and gives rows block by block."""

    def __init__(self, first_sequence: int, capacity: int, piece: int, block_tokens: int):
        self.sequence, self.capacity, self.piece, self.block_tokens = first_sequence, capacity, piece, block_tokens
        self.rests: list[tuple] = []
        self.held = 0

    def add(self, key, ids: bytes) -> list[tuple]:
        """Rows of the whole windows of a document; its rest is kept for the block."""
        total, view, rows = len(ids) // 4, memoryview(ids), []
        start = 0
        while start < total:
            whole = total - start >= self.capacity
            length = self.capacity if whole else min(self.piece, total - start)
            row = (key, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), total)
            if whole:
                rows.append((*row, self.sequence, 0))
                self.sequence += 1
            else:
                self.rests.append(row)
                self.held += length
            start += length
        return rows

    def close(self) -> list[tuple]:
        """Rows of the block's rests in their windows."""
        rows = []
        for group in pack([row[2] for row in self.rests], self.capacity):
            offset = 0
            for i in sorted(group):
                rows.append((*self.rests[i], self.sequence, offset))
                offset += self.rests[i][2]
            self.sequence += 1
        self.rests, self.held = [], 0
        return rows


def pack_documents(
    df: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    block_tokens: int = BLOCK_TOKENS,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Every document's ids end with ``end_id``, so null and empty texts are one piece of one
    id. ``sequence_id`` is unique over all tasks: the scan task's number above, a running
    number below. Repeated rows are packed like any other, null ids too; an empty table
    gives no rows; other columns are ignored. ``tokenizer_path`` is a file every executor
    has, by default the installed public vocabulary. Memory is bounded by a block.
    """
    schema = SCHEMA.format(id=id_col, id_type=df.schema[id_col].dataType.simpleString())
    target = arrow_schema(schema, df.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        import public_tokenizers
        import pyarrow as pa

        ids_of = tokenizer(tokenizer_path or public_tokenizers.path(TOKENIZER)).ids
        packer = BlockPacker(TaskContext.get().partitionId() << 33, capacity, piece, block_tokens)

        def batch_of(rows):
            columns = zip(*rows) if rows else [[] for _ in target]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), ids_of(texts)):
                rows += packer.add(key, ids + end)
                if packer.held >= block_tokens:
                    rows += packer.close()
            yield batch_of(rows)
        yield batch_of(packer.close())

    return df.select(id_col, text_col).mapInArrow(run, schema)


def op9_packing(spark, directory):
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(load(spark, directory, "documents"))


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
