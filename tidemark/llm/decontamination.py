"""Benchmark passages in documents, by a generalised suffix automaton over words.

All test items, normalised to words, go into one automaton. A document's words are streamed
through it; the state and the length of the longest match ending at each word tell which
item windows end there. The automaton is built from a block of items of bounded size, and
larger benchmarks are matched block after block over the same rows, so nothing of unbounded
size is broadcast and no exchange is needed.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import load

WINDOW = 10
BLOCK_BYTES = 4 << 20  # text of the items of one automaton

# Lower-case A-Z, keep digits and bytes over 127, and turn every other byte into a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")
SPANS = "array<struct<first:long,last:long,start:long,stop:long>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class SuffixAutomaton:
    """All substrings of a set of word sequences, with the windows marked that count."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, sequence in items:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.marks: dict[int, list[tuple[int, list[str]]]] = {}
        found: dict[tuple[int, int], set[str]] = {}
        for key, sequence in items:
            span = min(window, len(sequence))
            state = matched = 0
            for at, word in enumerate(sequence, 1):
                state, matched = self.step(state, matched, word)
                if at >= span > 0:
                    found.setdefault((self._state_of(state, span), span), set()).add(key)
        for (state, span), keys in found.items():
            self.marks.setdefault(state, []).append((span, sorted(keys)))
        # The nearest marked state on the way to the root, itself included.
        self.marked = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marked[state] = state if state in self.marks else self.marked[self.link[state]]

    def _new(self, length: int, link: int, step: dict) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.next, self.link, self.length
        if word in step[last]:
            target = step[last][word]
            return target if length[target] == length[last] + 1 else self._split(last, word, target)
        new = self._new(length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            target = step[at][word]
            link[new] = target if length[target] == length[at] + 1 else self._split(at, word, target)
        return new

    def _split(self, at: int, word: bytes, target: int) -> int:
        """A state for the shorter strings of ``target``, which end here more often."""
        copy = self._new(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state_of(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def step(self, state: int, matched: int, word: bytes) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        following = self.next[state].get(word)
        return (0, 0) if following is None else (following, matched + 1)

    def find(self, sequence: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged runs [first, last] of hit words and the ids of the items that hit."""
        step, link, length, marked, marks = self.next, self.link, self.length, self.marked, self.marks
        runs: list[list[int]] = []
        keys: set[str] = set()
        state = matched = 0
        root = step[0]
        for at, word in enumerate(sequence):
            if state:
                while state and word not in step[state]:
                    state = link[state]
                    matched = length[state]
                if state:
                    state = step[state][word]
                    matched += 1
                else:
                    state = root.get(word, 0)
                    matched = 1 if state else 0
            else:
                state = root.get(word, 0)
                matched = 1 if state else 0
            place = marked[state]
            while place:
                for span, owners in marks[place]:
                    if span <= matched:
                        keys.update(owners)
                        first = at - span + 1
                        while runs and runs[-1][1] >= first - 1:
                            first = min(first, runs.pop()[0])
                        runs.append([first, at])
                place = marked[link[place]]
        return runs, keys


_AUTOMATA: dict[str, SuffixAutomaton] = {}  # of the running block; one per worker


def item_blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """The items on the driver, in blocks of bounded size. Null ids count as ``null``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"), text.alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == number)
        yield [(row["key"], row["text"]) for row in block.toLocalIterator()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (runs of hit words: first and last word,
    first byte and byte after the last, in the UTF-8 text) and ``hit_items`` (sorted ids).
    ``prefix`` goes before these names; columns so named in ``docs`` are replaced.

    A window is ``window`` consecutive words of an item, or all words of a shorter one;
    items without words have none. Null and empty texts have no words. Items are told apart
    by id; a null id counts as the id ``null``.
    """
    spark = docs.sparkSession
    n_words, hit_spans, hit_items = (prefix + name for name in ("n_words", "hit_spans", "hit_items"))
    out = docs.drop(n_words, hit_spans, hit_items)
    out = out.select(
        *out.columns,
        F.lit(0).cast("long").alias(n_words),
        F.array().cast(SPANS).alias(hit_spans),
        F.array().cast("array<string>").alias(hit_items),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema.fields])
    for block in item_blocks(benchmark, block_bytes, item_id_col, item_text_col):
        out = out.mapInArrow(_matcher(spark.sparkContext.broadcast(block), window, text_col), schema)
    return out


def _matcher(block, window: int, text_col: str):
    key = uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa

        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = SuffixAutomaton([(k, words(t)) for k, t in block.value], window)
        automaton = _AUTOMATA[key]
        for batch in batches:
            counts, spans, items = [], [], []
            earlier = zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            for text, (old_spans, old_items) in zip(batch[text_col].to_pylist(), earlier):
                raw = (text or "").encode().translate(WORD_BYTES)
                sequence = raw.split()
                runs, keys = automaton.find(sequence)
                counts.append(len(sequence))
                if runs and old_spans:
                    runs = joined([*runs, *([s["first"], s["last"]] for s in old_spans)])
                spans.append(located(raw, runs) if runs else old_spans)
                items.append(sorted(keys | set(old_items)))
            found = [pa.array(c, f.type) for c, f in zip((counts, spans, items), [batch.schema.field(i) for i in range(batch.num_columns - 3, batch.num_columns)])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *found], schema=batch.schema)

    return run


def joined(runs: list[list[int]]) -> list[list[int]]:
    """Union of runs, those that touch as one."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def located(raw: bytes, runs: list[list[int]]) -> list[dict]:
    places = [m.span() for m in WORD.finditer(raw)]
    return [{"first": a, "last": b, "start": places[a][0], "stop": places[b][1]} for a, b in runs]


def hit_words(spans: str = "hit_spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.0, max_run: int = 0, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without benchmark passages: documents of which more than ``max_coverage``
    of the words are hit are removed; in the others, runs of more than ``max_run`` hit words
    are cut out of the text. With the limits at 0 every document with a hit goes. Columns
    and clean rows stay as they are."""
    found = find_passages(docs, benchmark, text_col=text_col, prefix="_passages_", **options)
    spans = "_passages_hit_spans"
    kept = found.where(hit_words(spans) <= F.lit(float(max_coverage)) * F.col("_passages_n_words"))
    raw = F.col(text_col).cast("binary")
    long_runs = F.filter(spans, lambda s: s["last"] - s["first"] + 1 > max_run)
    # Kept pieces between the cut runs; offsets are bytes.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").cast("binary").alias("kept"))
    cut = F.aggregate(
        long_runs,
        start,
        lambda s, run: F.struct(
            run["stop"].alias("at"),
            F.concat(s["kept"], F.substring(raw, (s["at"] + 1).cast("int"), (run["start"] - s["at"]).cast("int"))).alias("kept"),
        ),
        lambda s: F.concat(s["kept"], F.substring(raw, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    text = F.when(F.size(long_runs) > 0, cut.cast("string")).otherwise(F.col(text_col))
    return kept.withColumn(text_col, text).select(*docs.columns)


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` (of the sorted ids, comma-joined), ``contaminated``."""
    text_col = options.get("text_col", "text")
    found = find_passages(docs.select(id_col, text_col), benchmark, **options)
    return found.select(
        id_col,
        "n_words",
        hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def op10_decontamination(spark, directory):
    """Hits of benchmark windows in every document."""
    return contamination_report(load(spark, directory, "documents"), load(spark, directory, "benchmark"))


QUERIES = {"op10_decontamination": op10_decontamination}

ORACLES = {
    "op10_decontamination": r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM lowered),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) x),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n) x),
hits AS (SELECT doc_id, g.n, i, item_id FROM grams g JOIN windows USING (n, gram)),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hits),
hit AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) x GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
}
