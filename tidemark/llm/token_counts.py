"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

The vocabulary is a public sentencepiece model of the byte-pair kind. A text is normalised
as the model says and cut where no merge can cross: before a space mark that follows
another character (no piece of the vocabulary joins them, which is checked when the model
is loaded) and between two characters that stand side by side in no piece. Every part is merged alone:
the adjacent pair of lowest rank, leftmost first, leaves the heap and the list closes over
it. The count is the number of symbols at the start less the merges; a symbol outside the
vocabulary counts as its bytes.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from tidemark.llm.common import load, map_rows

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SPACE_MARK = "▁"
# Parts whose counts a worker remembers; the memory is emptied when it is full.
REMEMBERED_PARTS = 1_000_000

SCHEMA = "{id} {id_type}, n_bytes long, n_tokens long, over_limit boolean"


class PieceMerger:
    """Counts tokens of texts; one per worker."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        scores = {model.id_to_piece(i): -model.get_score(i) for i in range(size) if i not in special}
        place = {score: rank for rank, score in enumerate(sorted(set(scores.values())))}
        pieces = {piece: place[score] for piece, score in scores.items()}
        self.ranks = pieces
        self.single = frozenset(piece for piece in pieces if len(piece) == 1)
        self.joined = frozenset(piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1))
        self.byte_fallback = any(model.is_byte(i) for i in range(size))
        self.line_ends_alone = not any("\n" in pair for pair in self.joined)
        self.cut_at_marks = not any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces)
        self.normalize = model.normalize
        self.known: dict[str, int] = {}

    def merged_count(self, part: str) -> int:
        """Tokens of one part: heap of candidate pairs over a linked list of symbols. A heap
        entry is rank, place and span of a pair in one number, so the lowest rank leaves
        first and of equal ranks the leftmost."""
        rank_of, n = self.ranks.get, len(part)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        length = [1] * n  # 0: taken up by the symbol on its left
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = rank_of(part[i : i + 2])
            if rank is not None:
                heap.append((rank << bits | i) << bits | 2)
        heapify(heap)
        count = n
        while heap:
            entry = heappop(heap)
            left, span = entry >> bits & mask, entry & mask
            own = length[left]
            right = left + own
            if own == 0 or right >= n or own + length[right] != span:
                continue  # one side was merged otherwise since
            length[right] = 0
            length[left] = span
            count -= 1
            after = left + span
            if after < n:
                before[after] = left
                end = after + length[after]
                rank = rank_of(part[left:end])
                if rank is not None:
                    heappush(heap, (rank << bits | left) << bits | end - left)
            front = before[left]
            if front >= 0:
                rank = rank_of(part[front:after])
                if rank is not None:
                    heappush(heap, (rank << bits | front) << bits | after - front)
        if self.byte_fallback and not self.single.issuperset(part):
            i = 0
            while i < n:
                if length[i] == 1 and part[i] not in self.single:
                    count += len(part[i].encode()) - 1
                i += length[i]
        return count

    def missing(self, part: str) -> int:
        """Count and remember a part that is new to this worker."""
        if len(self.known) >= REMEMBERED_PARTS:
            self.known.clear()
        joined, start, total = self.joined, 0, 0
        for i in range(1, len(part)):
            if part[i - 1 : i + 1] not in joined:  # no piece holds this pair: no merge crosses it
                total += self.merged_count(part[start:i]) if i - start > 1 else self.alone_count(part[start])
                start = i
        total += self.merged_count(part[start:])
        self.known[part] = total
        return total

    def alone_count(self, symbol: str) -> int:
        return len(symbol.encode()) if self.byte_fallback and symbol not in self.single else 1

    def count(self, text: str) -> int:
        normal = self.normalize(text)
        if not normal:
            return 0
        if not self.cut_at_marks:
            return self.missing(normal)
        lines = normal.split("\n") if self.line_ends_alone else [normal]
        total = self.alone_count("\n") * (len(lines) - 1)
        known, missing = self.known, self.missing
        for line in lines:
            if DOUBLE_MARK in line:
                parts = PARTS(line)
            else:
                head, *rest = line.split(SPACE_MARK)
                parts = [SPACE_MARK + part for part in rest]
                if head:
                    parts.append(head)
            counts = [*map(known.get, parts)]
            if None in counts:
                counts = [missing(parts[i]) if c is None else c for i, c in enumerate(counts)]
            total += sum(counts)
        return total


DOUBLE_MARK = SPACE_MARK * 2
PARTS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+").findall
_MERGERS: dict[str, PieceMerger] = {}


def merger(model_path: str) -> PieceMerger:
    if model_path not in _MERGERS:
        _MERGERS[model_path] = PieceMerger(model_path)
    return _MERGERS[model_path]


def count_tokens(
    df: DataFrame,
    model_path: str | None = None,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    A narrow pass without an exchange. ``model_path`` is a file every executor has; by
    default the installed public vocabulary. Null and empty texts have no bytes and no
    tokens; ids may be null or repeated; an empty table gives no rows; other columns are
    ignored. A text of any length is taken whole, in n log n steps even without spaces.
    """

    def run(ids, texts):
        import public_tokenizers

        count = merger(model_path or public_tokenizers.path(MODEL)).count
        texts = [t or "" for t in texts]
        tokens = [count(t) for t in texts]
        return {
            id_col: ids,
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    schema = SCHEMA.format(id=id_col, id_type=df.schema[id_col].dataType.simpleString())
    return map_rows(df, [id_col, text_col], run, schema)


def op8_token_counts(spark, directory):
    """Tokens of every document by the sentencepiece vocabulary."""
    return count_tokens(load(spark, directory, "documents"))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLES: dict[str, str] = {}
