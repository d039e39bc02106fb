"""Text scores by a probabilistic suffix tree over bytes, and by word counts.

Training counts every byte with the up to seven bytes before it, over all training texts, in
two passes. The first counts contexts of up to three bytes, and how often longer ones fall
into each of ``BUCKETS`` buckets. A context cannot be frequent if all of its bucket together is
not: the second pass leaves such contexts out before they are shuffled, and no frequent one. A
context is kept if it is frequent enough and its next-byte distribution differs from that
of the next shorter context by a divergence test; distributions are smoothed with those of
shorter contexts. For scoring the tree becomes an automaton whose state is the longest kept
suffix of what was read, so a text costs one table look-up a byte.

The base score sums over words. Words with a share of at least ``COMMON`` of all tokens are
at most ``1 / COMMON`` many and are broadcast; the others are joined. Words are told apart
by 64-bit hashes (among a billion words two are confused with a chance of one in thirty).
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, chunks_of_bytes, load, scratch, word_hashes, written

FOLDS, HELD_OUT = 7, 2
DEPTH = 7  # longest context in bytes: eight bytes make one number
# A context needs this share of all bytes: at most 1 / FREQUENT contexts of each length.
FREQUENT = 1e-5
COMMON = 2e-6
END = 10  # the byte that ends a text and, repeated, stands before it; no word holds it
SHORT = 3  # contexts up to this length are all counted, longer ones if their bucket is frequent
# Buckets of each length. They get a share of 2e-6 on average, so that few without a frequent
# context reach ``FREQUENT``; a block of them is a row of the exchange.
BUCKET_BITS = 19
BUCKETS, BLOCK = 1 << BUCKET_BITS, 1 << 10
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
LANES = 2048
FLUSH = 1_000_000
PLACES = 1 << 20  # bytes of texts counted at once; of a longer text twice as many
ROWS = 1 << 16  # handed to Spark at once
WORD, GRAM, TEXTS, BUCKET = 0, 1, 2, 3
BUCKETED = range(SHORT + 2, DEPTH + 1)  # contexts a byte shorter are counted grams


def plain_bytes(text: str | None) -> bytes:
    """A-Z lower-cased, words with single blanks between them."""
    return b" ".join((text or "").encode().lower().split())


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte array, each after ``DEPTH`` end bytes and with one at its end;
    where each begins, and which bytes are to be predicted."""
    lead = bytes([END]) * DEPTH
    data = np.frombuffer(b"".join([lead + t + lead[:1] for t in texts]), np.uint8)
    begins = np.cumsum([0, *(len(t) + DEPTH + 1 for t in texts)])[:-1]
    wanted = np.ones(len(data), bool)
    wanted[(begins[:, None] + np.arange(DEPTH)).ravel()] = False
    return data, begins, wanted


def grams(data: np.ndarray) -> np.ndarray:
    """Every byte from place ``DEPTH`` on with the ``DEPTH`` bytes before it, together as a
    number whose lowest byte is the last."""
    return np.ndarray(len(data) - DEPTH, ">i8", np.ascontiguousarray(data), 0, (1,)).astype(np.int64)


def all_grams(texts: list[bytes]):
    """The grams of all bytes of the texts, of some ``PLACES`` bytes at once."""
    data, _, wanted = stream(texts)
    for first in range(0, len(data) - DEPTH, 2 * PLACES):
        last = first + 2 * PLACES + DEPTH
        yield grams(data[first:last])[wanted[first + DEPTH : last]]


def buckets(found: np.ndarray, length: int) -> np.ndarray:
    """The bucket of the context of this length in every gram."""
    context = found.view(np.uint64) >> np.uint64(8)
    context <<= np.uint64(8 * (8 - length))
    context *= _SPREAD
    context >>= np.uint64(64 - BUCKET_BITS)
    return context.view(np.int64)


def lowest(found: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of every gram."""
    return found if size > DEPTH else found & np.int64((1 << 8 * size) - 1)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")  # they are few ordered runs
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Tally:
    """Counts of numbers, merged now and then so that memory stays bounded."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.merged = self.new = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.new += len(self.parts[-1][0])
        if self.new > FLUSH // 2:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        both = _summed(*(np.concatenate(c) for c in zip(*self.parts))) if self.parts else (np.empty(0, np.int64),) * 2
        self.parts, self.merged, self.new = [both], len(both[0]), 0
        return both

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        both = self.merge()
        self.parts, self.merged = [], 0
        return both


def _handed_on(tallies: dict[int, Tally], target: pa.Schema, least: int = -1):
    """Rows of ``kind``, ``item``, ``n`` of the tallies that hold more than ``least``, which
    start anew."""
    for kind, tally in tallies.items():
        if tally.merged <= least:
            continue
        keys, counts = tally.take()
        for first in range(0, len(keys), ROWS):
            own = slice(first, first + ROWS)
            columns = [np.full(len(keys[own]), kind, np.int32), keys[own].astype(np.int64), counts[own].astype(np.int64)]
            columns += [pa.nulls(len(columns[0]), f.type) for f in list(target)[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=target)


def corpus_counts(training: DataFrame, text_col: str) -> DataFrame:
    """``kind``, ``item``, ``n``, ``counters`` of every task: counts of contexts of ``SHORT``
    bytes with the next byte, of word hashes and of texts; and for each length of ``BUCKETED``
    the buckets of all contexts, a block of them in ``counters``."""
    schema = "kind int, item long, n long, counters binary"
    target = arrow_schema(schema, training.sparkSession)

    def run(batches):
        tallies, texts = {WORD: Tally(), GRAM: Tally()}, 0
        filled = np.zeros((len(BUCKETED), BUCKETS), np.int64)
        for batch in batches:
            raw = [plain_bytes(t) for t in batch.column(0).to_pylist()]
            texts += len(raw)
            for first, last in chunks_of_bytes(raw, PLACES):
                own = raw[first:last]
                for found in all_grams(own):
                    tallies[GRAM].add(lowest(found, SHORT + 1).astype(np.uint32))
                    for sums, length in zip(filled, BUCKETED):
                        sums += np.bincount(buckets(found, length), minlength=BUCKETS)
                tallies[WORD].add(word_hashes(own)[0].view(np.int64))
            yield from _handed_on(tallies, target, FLUSH)  # still, after merging
        yield from _handed_on(tallies, target)
        blocks = filled.reshape(-1, BLOCK)
        for first in range(0, len(blocks), 256):
            items = first + np.flatnonzero(blocks[first : first + 256].any(axis=1))
            packed = [b.astype(np.min_scalar_type(b.max())).tobytes() for b in blocks[items]]
            columns = [np.full(len(items), BUCKET, np.int32), items, np.zeros(len(items), np.int64), packed]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)
        yield pa.RecordBatch.from_pylist([{"kind": TEXTS, "item": 0, "n": texts}], schema=target)

    return written(training.select(text_col).mapInArrow(run, schema), "partial")


def frequent_buckets(partial: DataFrame, counts: DataFrame, least: float) -> np.ndarray:
    """For each length above ``SHORT`` the buckets that hold what was seen at least so often
    by all tasks together: ``BUCKETS`` bits a length, whatever the corpus."""
    schema = "item long, bits binary"
    target = arrow_schema(schema, partial.sparkSession)

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for item, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(raw, f"u{len(raw) // BLOCK}").astype(np.int64)
                sums[item] = sums[item] + own if item in sums else own
        bits = [np.packbits(s >= least).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(bits, pa.binary())], schema=target)

    blocks = partial.where(F.col("kind") == BUCKET).select("item", "counters").repartition("item")
    found = blocks.mapInArrow(run, schema).toArrow()
    out = np.zeros((len(BUCKETED) * BUCKETS // BLOCK, BLOCK), bool)
    for item, raw in zip(*(c.to_pylist() for c in found.columns)):
        out[item] = np.unpackbits(np.frombuffer(raw, np.uint8))
    # What stands before a byte was itself counted as a gram, but before a text's first byte.
    often = counts.where((F.col("kind") == GRAM) & (F.col("n") >= least)).select("item").toArrow()["item"].to_numpy()
    before = np.append(often, int.from_bytes(bytes([END]) * (SHORT + 1), "big"))
    shortest = np.zeros(BUCKETS, bool)
    shortest[buckets(before << 8, SHORT + 1)] = True
    return np.concatenate([shortest[None], out.reshape(len(BUCKETED), BUCKETS)])


def longer_counts(training: DataFrame, text_col: str, alive: np.ndarray) -> DataFrame:
    """``kind``, ``item``, ``n``: every byte with its longest context that lies, as all shorter
    ones do, in a frequent bucket; ``kind`` is the length. Every task sums its own first."""
    schema = "kind int, item long, n long"
    target = arrow_schema(schema, training.sparkSession)
    shared = training.sparkSession.sparkContext.broadcast(alive)

    def run(batches):
        tallies = {length: Tally() for length in range(SHORT + 1, DEPTH + 1)}
        for batch in batches:
            raw = [plain_bytes(t) for t in batch.column(0).to_pylist()]
            for first, last in chunks_of_bytes(raw, PLACES):
                for found in all_grams(raw[first:last]):
                    for length in tallies:
                        stays = shared.value[length - SHORT - 1][buckets(found, length)]
                        if length > SHORT + 1:
                            tallies[length - 1].add(lowest(found[~stays], length))
                        found = found[stays]
                    tallies[DEPTH].add(found)
            yield from _handed_on(tallies, target, FLUSH)
        yield from _handed_on(tallies, target)

    return training.select(text_col).mapInArrow(run, schema).groupBy("kind", "item").agg(F.sum("n").alias("n"))


def frequent_contexts(gram: DataFrame, least: float) -> DataFrame:
    """``length``, ``context``, ``symbol``, ``n``, ``total`` of the contexts that were seen at
    least so often; ``gram`` stands for contexts of ``low`` to ``high`` bytes."""
    length = F.explode(F.sequence("low", "high")).alias("length")
    mask = F.expr("shiftleft(1L, 8 * length) - 1")
    ends = (
        gram.select("item", "n", length)
        .select("length", F.shiftright("item", 8).bitwiseAND(mask).alias("context"), F.col("item").bitwiseAND(F.lit(255).cast("long")).alias("symbol"), "n")
        .groupBy("length", "context", "symbol")
        .agg(F.sum("n").alias("n"))
    )
    ends = written(ends, "ends")
    totals = ends.groupBy("length", "context").agg(F.sum("n").alias("total")).where(F.col("total") >= least)
    return written(ends.join(totals, ["length", "context"]), "contexts")


Contexts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def kept_contexts(training: DataFrame, text_col: str, partial: DataFrame, counts: DataFrame, frequent: float = FREQUENT) -> Contexts:
    """Arrays of length, context, symbol and n of the contexts that stay, and all shorter
    ones they end in, in order of length and context. Their number is bounded by the share a
    context needs. ``partial`` and ``counts`` are those of the first pass."""
    short = counts.where(F.col("kind") == GRAM)
    total = short.agg(F.sum("n")).first()[0]
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    alive = frequent_buckets(partial, counts, frequent * total)
    longer = longer_counts(training, text_col, alive)
    gram = short.select("item", "n", F.lit(0).alias("low"), F.lit(SHORT).alias("high")).unionByName(
        longer.select("item", "n", F.lit(SHORT + 1).alias("low"), F.col("kind").alias("high"))
    )
    often = frequent_contexts(gram, frequent * total)
    shorter = F.expr("context & (shiftleft(1L, 8 * greatest(length - 1, 0)) - 1)")
    parent = often.select(
        (F.col("length") + 1).alias("length"), F.col("context").alias("shorter"), "symbol", (F.col("n") / F.col("total")).alias("share")
    )
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("share")))
    differs = (
        often.where("length > 0")
        .withColumn("shorter", shorter)
        .join(parent, ["length", "shorter", "symbol"])
        .groupBy("length", "context")
        .agg(gain.alias("gain"))
        .where(F.col("gain") > math.log(total))
        .select("length", "context")
    )
    # A kept context keeps the shorter ones it ends in.
    upward = differs.select(F.expr("explode(sequence(0, length))").alias("l"), "context").select(
        F.col("l").alias("length"), F.expr("context & (shiftleft(1L, 8 * l) - 1)").alias("context")
    )
    root = often.where("length = 0").select("length", "context")
    chosen = upward.union(root).distinct()
    kept = often.join(chosen, ["length", "context"], "left_semi")
    kept = kept.select(F.col("length").cast("byte").alias("length"), "context", F.col("symbol").cast("short").alias("symbol"), "n")
    columns = [c.to_numpy() for c in kept.toArrow().columns]
    order = np.lexsort((columns[2], columns[1], columns[0]))
    return tuple(c[order] for c in columns)


class SuffixTree:
    """Automaton of the kept contexts: next state and log10 probability of every byte."""

    def __init__(self, kept_rows: Contexts):
        lengths, contexts, symbols, counts = kept_rows
        new = np.append(True, (lengths[1:] != lengths[:-1]) | (contexts[1:] != contexts[:-1])) if len(lengths) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        ends = np.append(first[1:], len(lengths))
        # Each context with the stretch of its next symbols.
        follow: dict[bytes, tuple[int, int]] = {b"": (0, 0)}
        for at, end in zip(first.tolist(), ends.tolist()):
            follow[int(contexts[at]).to_bytes(int(lengths[at]), "big")] = (at, end)
        kept = set(follow)
        self.symbols = sorted({END, *np.unique(symbols).tolist()})
        width = len(self.symbols) + 1  # the last class: bytes never seen
        self.width = width
        self.symbol_class = np.full(256, width - 1, np.int64)
        self.symbol_class[self.symbols] = np.arange(width - 1)
        classes = self.symbol_class[symbols]
        states = set(kept)
        for context in kept:  # what an automaton reads on the way to a context
            states.update(context[:i] for i in range(1, len(context)))
        order = sorted(states, key=lambda c: (len(c), c))
        place = {c: i for i, c in enumerate(order)}
        probability = np.zeros((len(order), width), np.float32)
        onward = np.zeros((len(order), width), np.int32)
        back = np.zeros(len(order), np.int64)  # longest shorter suffix that is a state
        for i, context in enumerate(order):
            suffix = context[1:]
            while suffix and suffix not in place:
                suffix = suffix[1:]
            back[i] = place[suffix] if i else 0
        root = probability[0]
        seen = slice(*follow[b""])
        total = int(counts[seen].sum()) + 256
        root[:-1] = 1 / total
        root[-1] = 1 / total  # of each byte never seen
        root[classes[seen]] = (counts[seen] + 1) / total
        # All states of a length at once; what they take over is of shorter ones.
        sizes = np.array([len(c) for c in order])
        levels = np.searchsorted(sizes, np.arange(sizes[-1] + 2))
        leads_from = np.array([0, *(place[c[:-1]] for c in order[1:])])
        leads_by = np.array([0, *(self.symbol_class[c[-1]] for c in order[1:])])
        stretch = np.array([follow.get(c, (0, 0)) for c in order])
        for size, (start, end) in enumerate(zip(levels[:-1], levels[1:])):
            here = np.arange(start, end)
            if size:
                onward[here] = onward[back[here]]
                # Shorter contexts weigh as much as there are different next bytes here.
                weight = stretch[here, 1] - stretch[here, 0]
                own, weight = here[weight > 0], weight[weight > 0]
                probability[here] = probability[back[here]]
                probability[own] *= weight.astype(np.float32)[:, None]
                row = np.repeat(own, weight)
                at = np.concatenate([np.arange(*s) for s in stretch[own]]) if len(own) else np.zeros(0, np.int64)
                probability[row, classes[at]] += counts[at].astype(np.float32)
                sums = np.add.reduceat(counts[at], np.cumsum(weight) - weight) if len(own) else weight
                probability[own] /= (sums + weight).astype(np.float32)[:, None]
            longer = np.arange(end, levels[size + 2] if size + 2 < len(levels) else end)
            onward[leads_from[longer], leads_by[longer]] = longer
        self.onward = onward.ravel()
        self.log = np.log10(probability, out=probability).ravel()
        self.states = len(order)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of every text with its end."""
        data, begins, wanted = stream(texts)
        classes = self.symbol_class[data]
        lanes = min(LANES, max(1, len(data) // (8 * DEPTH)))
        each = -(-len(data) // lanes)
        padded = np.concatenate([np.full(DEPTH, self.symbol_class[END]), classes, np.full(lanes * each - len(data), self.symbol_class[END])])
        # Every lane reads the DEPTH bytes before its own: they decide its first state.
        places = np.arange(lanes) * each
        state = np.zeros(lanes, np.int64)
        logs = np.empty((each, lanes), np.float32)
        for t in range(each + DEPTH):
            at = state * self.width + padded[places + t]
            if t >= DEPTH:
                logs[t - DEPTH] = self.log[at]
            state = self.onward[at]
        flat = logs.T.ravel()[: len(data)].astype(np.float64)
        flat[~wanted] = 0
        return np.add.reduceat(flat, begins)


_TREES: dict[str, SuffixTree] = {}


def score_texts(docs: DataFrame, learn: Column, frequent: float = FREQUENT, common: float = COMMON, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``. Rows where ``learn`` is true are learned from; all are scored.

    Null and empty texts are the end token alone. Null or repeated ids do not matter, as
    rows are told apart by their place; an empty table gives no rows, and with nothing to
    learn from all bytes are equally likely; other columns are ignored.
    """
    spark = docs.sparkSession
    training = docs.where(learn)
    with scratch(spark) as keep:
        partial = corpus_counts(training, text_col)
        plain = partial.where(F.col("kind") != BUCKET)
        counts = keep(written(plain.groupBy("kind", "item").agg(F.sum("n").alias("n")), "counts"))
        tree = kept_contexts(training, text_col, partial, counts, frequent)
    words = counts.where(F.col("kind") == WORD)
    known, tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    texts = counts.where(F.col("kind") == TEXTS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens += texts
    different = known + (texts > 0)
    denominator = math.log10(tokens + different + 1)
    often = words.where(F.col("n") >= common * tokens).select("item", "n").orderBy("item").toArrow()
    shared = spark.sparkContext.broadcast((often["item"].to_numpy(), often["n"].to_numpy(), tree))
    key = uuid.uuid4().hex
    end_log = math.log10(texts + 1)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, id {kind}, n_tokens long, n_known long, base double, score double, rare array<long>"
    target = arrow_schema(schema, spark)

    def run(batches):
        items, ns, rows = shared.value
        if key not in _TREES:
            _TREES.clear()
            _TREES[key] = SuffixTree(rows)
        model = _TREES[key]
        logs = np.log10(ns + 1.0)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            raw = [plain_bytes(t) for t in batch.column(1).to_pylist()]
            parts = []
            for first, last in chunks_of_bytes(raw):
                own = raw[first:last]
                hashes, begins = word_hashes(own)
                hashes = hashes.view(np.int64)
                at = np.searchsorted(items, hashes)
                hit = items[np.minimum(at, max(0, len(items) - 1))] == hashes if len(items) else np.zeros(len(hashes), bool)
                value = np.zeros(len(hashes) + 1)
                value[1:][hit] = logs[at[hit]]
                sums, hits = np.cumsum(value), np.concatenate([[0], np.cumsum(hit)])
                left = np.concatenate([[0], np.cumsum(~hit)])[begins]
                size = np.diff(begins)
                parts.append((size + 1, np.diff(hits[begins]), np.diff(sums[begins]), model.scores(own), np.diff(left), hashes[~hit]))
            n_tokens, n_known, base, score, left, rare = (np.concatenate(c) for c in zip(*parts))
            rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)), pa.array(rare))
            columns = [pa.array(row + np.arange(len(raw))), batch.column(0), *map(pa.array, (n_tokens, n_known, base, score))]
            yield pa.RecordBatch.from_arrays([*columns, rare.cast(target.field("rare").type)], schema=target)
            row += len(raw)

    scored = written(docs.select(id_col, text_col).mapInArrow(run, schema), "scored")
    counted = words.where(F.col("n") < common * tokens).select("item", "n")
    joined = (
        scored.select("row", F.explode("rare").alias("item"))
        .join(counted, "item")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("logs"))
    )
    return scored.join(joined, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0)) + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(denominator)).alias("base_score"),
        "score",
    )


def op4_language_model(spark, directory):
    """Scores of all documents, learned outside the held-out fold. A row with a null id is
    not held out."""
    docs = load(spark, directory, "documents")

    def held_out():
        return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))

    return score_texts(docs, ~held_out()).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES = {"op4_language_model": op4_language_model}
ORACLES: dict[str, str] = {}
