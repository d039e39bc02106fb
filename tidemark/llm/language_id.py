"""Language by cross-parsing entropy over suffix automata.

Labelled text of every language becomes a suffix automaton. A text is cross-parsed against
each: repeatedly the longest match at the current place is taken as one phrase. The language
that needs the fewest phrases per letter wins. Parsing starts anew at every word, so the
phrases of a word are counted once and remembered, and whole texts cost a look-up a word.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import load

UNKNOWN = "und"
FOLDS = 5
# Bounds of the labelled sample: rows and distinct words of a language that are learned.
SAMPLE_ROWS = 400
SAMPLE_LETTERS = 40_000
REMEMBERED_WORDS = 300_000

# Runs of letters and the marks that combine with them (vowel signs, accents, joiners);
# digits, signs and blanks part words. Numbers that are no digits, such as
# superscripts, may stand in a word but do not make one.
_MARKS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Mn", "Mc")) + "\u200c\u200d"
_NO_MARK = frozenset(_MARKS).isdisjoint
_PLAIN_WORDS = re.compile(r"[^\W\d_]+").findall
_MARKED_WORDS = re.compile(rf"[^\W\d_]+(?:[{_MARKS}]+[^\W\d_]*)*").findall


def WORDS(text: str) -> list[str]:
    return _PLAIN_WORDS(text) if text.isascii() or _NO_MARK(text) else _MARKED_WORDS(text)


class WordAutomaton:
    """Suffix automaton of words, each between blanks. No phrase spans two words."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        for word in words:
            last = 0
            for sign in f" {word} ":
                last = self._extend(last, sign)

    def _add(self, length: int, link: int, step: dict[str, int]) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _part(self, at: int, sign: str, target: int) -> int:
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._add(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while at >= 0 and self.next[at].get(sign) == target:
            self.next[at][sign] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, sign: str) -> int:
        if sign in self.next[last]:
            return self._part(last, sign, self.next[last][sign])
        new, at = self._add(self.length[last] + 1, 0, {}), last
        while at >= 0 and sign not in self.next[at]:
            self.next[at][sign] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._part(at, sign, self.next[at][sign])
        return new

    def phrases(self, word: str) -> int:
        """Longest matches, one after the other, that make up ``word`` between blanks."""
        step, count, state, fresh = self.next, 0, 0, True
        for sign in f" {word} ":
            following = step[state].get(sign)
            if following is None:
                count += not fresh
                following = step[0].get(sign)
                if following is None:  # a sign the language never shows is a phrase
                    count += 1
                    state, fresh = 0, True
                    continue
            state, fresh = following, False
        return count + (not fresh)


class LanguageModel:
    """Automata of all languages; one per worker."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.automata = [WordAutomaton(samples[name]) for name in self.languages]
        self.known: dict[str, tuple[int, ...]] = {}

    def _phrases(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= REMEMBERED_WORDS:
            self.known.clear()
        lowered = word.lower()
        found = self.known.get(lowered)
        if found is None:
            found = self.known[lowered] = tuple(a.phrases(lowered) for a in self.automata)
        self.known[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """Language, score, and phrases per letter of the best language."""
        words = [word for word in WORDS(text or "") if word.isalpha() or any(map(str.isalpha, word))]
        if not words or not self.languages:
            return UNKNOWN, 0.0, None
        known, count = self.known.get, self._phrases
        phrases = np.array([known(word) or count(word) for word in words]).sum(axis=0)
        letters = sum(map(len, words))
        order = np.argsort(phrases, kind="stable")
        best = int(phrases[order[0]])
        # Chance of the best against the next, each phrase worth one bit.
        gap = int(phrases[order[1]]) - best if len(order) > 1 else letters
        return self.languages[order[0]], 1.0 / (1.0 + 2.0 ** -min(gap, 60)), best / letters


_MODELS: dict[str, LanguageModel] = {}


def training_samples(
    labelled: DataFrame, rows: int, letters: int, id_col: str, text_col: str, label_col: str
) -> dict[str, list[str]]:
    """Distinct words of every label from a bounded sample of rows, taken by a hash of the
    id and the same at every run. The number of labels is the number of languages."""
    counts = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    order = F.abs(F.hash(F.lit("sample"), F.col(id_col), F.col(text_col))) / F.lit(2.0**31)
    share = F.coalesce(
        *[F.when(F.col(label_col) == name, F.lit(2.0 * rows / count)) for name, count in counts.items()], F.lit(0.0)
    )
    few = labelled.select(label_col, text_col, order.alias("place")).where(F.col("place") < share)
    samples: dict[str, Counter] = {name: Counter() for name in counts}
    size = dict.fromkeys(counts, 0)
    for name, text, _ in few.orderBy("place", text_col).toLocalIterator():
        if size[name] >= letters:
            continue
        for word in WORDS(text.lower()):
            if word not in samples[name] and size[name] < letters:
                size[name] += len(word) + 2
                samples[name][word] += 1
    return {name: list(words) for name, words in samples.items() if words}


def identify(
    df: DataFrame,
    labelled: DataFrame,
    rows: int = SAMPLE_ROWS,
    letters: int = SAMPLE_LETTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    prefix: str = "",
) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``phrase_rate`` (phrases per letter
    of the best language). Only ``text_col`` of ``df`` is read for a prediction.

    ``labelled`` rows without text or label are passed over. A text that is null or has no
    letter, and every text where nothing was learned, is ``und`` with score 0. Ties go to
    the label that sorts first. ``prefix`` goes before these names; columns so named in
    ``df`` are replaced.
    """
    labelled = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    samples = df.sparkSession.sparkContext.broadcast(
        training_samples(labelled, rows, letters, id_col, text_col, label_col)
    )
    key = uuid.uuid4().hex
    names = [prefix + name for name in ("lang_pred", "score", "phrase_rate")]
    base = df.drop(*names)

    def run(batches):
        import pyarrow as pa

        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = LanguageModel(samples.value)
        predict = _MODELS[key].predict
        for batch in batches:
            found = [predict(text) for text in batch[text_col].to_pylist()]
            languages, scores, rates = ([f[i] for f in found] for i in range(3))
            columns = [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])
        # The worker may go on to other stages: it keeps nothing of this one.
        _MODELS.clear()

    schema = T.StructType([*base.schema.fields])
    schema = schema.add(names[0], "string").add(names[1], "double").add(names[2], "double")
    return base.mapInArrow(run, schema)


def fold(id_col: str, folds: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op2_language_id(spark, directory):
    """Language of every document, learned outside the held-out fold.

    A null id is in no fold: such rows are neither held out nor learned from. Repeated rows
    and ids get equal results; an empty table gives no rows; other columns are ignored.
    """
    docs = load(spark, directory, "documents")
    rest = F.coalesce(fold("doc_id", FOLDS), F.lit(-1))
    found = identify(docs.select("doc_id", "text"), docs.where(rest > 0))
    return found.select("doc_id", (rest == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}
