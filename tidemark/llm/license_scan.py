"""License texts in documents by diagonal voting.

Every rolling 3-word hash of a document is joined to the template positions with that hash.
A match votes for the diagonal (place in the document minus place in the template); votes are
aggregated by diagonal, neighbouring diagonals, which an inserted or missing word separates,
are merged, and what has enough votes is verified word by word against the text.

A template of n words that occurs with e changed words keeps at least n - 2 - 3e of its
hashes, on diagonals at most e apart, so neither the merging nor the least number of votes
loses an occurrence. Phrases must match in full: all of their hashes vote for one diagonal.

Only the template positions, whose number is checked, are broadcast. Rows without a template
leave the plan at that join, so what is shuffled is one row per document and the votes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, chunks_of_bytes, load, mix, word_hashes, written
from tidemark.llm.decontamination import WORD_BYTES, words

GRAM = 3
SHARE_CHANGED = 0.2  # of the words of a template
EXACT_BELOW = 8  # shorter templates must match in full
MAX_POSITIONS = 200_000  # template positions that may be broadcast

# Fixed values of the contract: phrases and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Notices of common licenses. Each is looked for as a whole.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "GNU General Public License version 3"),
    ("gpl", "it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    is_phrase: bool
    changed: int  # words that may differ

    @property
    def grams(self) -> int:
        return len(self.words) - GRAM + 1

    @property
    def least_votes(self) -> int:
        return max(1, self.grams - GRAM * self.changed)


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    """Phrases and notices as words; each has at least three."""
    out = []
    for is_phrase, pairs in ((True, phrases), (False, notices)):
        for label, text in pairs:
            sequence = tuple(words(text))
            if len(sequence) < GRAM:
                raise ValueError(f"a template needs {GRAM} words: {text!r}")
            loose = 0 if is_phrase or len(sequence) < EXACT_BELOW else int(SHARE_CHANGED * len(sequence))
            out.append(Template(label, sequence, is_phrase, loose))
    return out


# ---- rolling hashes

_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _rolled(hashes: np.ndarray) -> np.ndarray:
    n = max(len(hashes) - GRAM + 1, 0)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        total += mix(hashes[i : i + n] * factor)
    return mix(total)


def gram_arrays(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For cleaned texts: words of each, and of every 3-word hash the text it lies in, its
    first word and the hash."""
    hashes, begins = word_hashes(texts)
    counts = np.diff(begins)
    rolled = _rolled(hashes)
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = owner[: len(rolled)] == owner[GRAM - 1 :] if len(rolled) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    return counts, owner[at], at - begins[owner[at]], rolled[at].view(np.int64)


def _positions(spark: SparkSession, found: list[Template]) -> DataFrame:
    rows = []
    for number, template in enumerate(found):
        _, _, at, grams = gram_arrays([b" ".join(template.words)])
        rows += [(int(g), number, int(p)) for p, g in zip(at, grams)]
    if len(rows) > MAX_POSITIONS:
        raise ValueError(f"{len(rows)} template positions; at most {MAX_POSITIONS} are broadcast")
    return spark.createDataFrame(rows, "_gram long, _template int, _template_at int")


def _grams(docs: DataFrame) -> DataFrame:
    """One row for each 3-word hash of ``docs`` (_id, _mark, _text), and one at -1 for the
    row itself."""
    ddl = "_mark long, _n_words long, _at long, _gram long"
    from pyspark.sql import types as T

    schema = T.StructType([docs.schema["_id"], *T._parse_datatype_string(ddl).fields])
    arrow = pa.schema([pa.field("_id", _id_type(docs)), *arrow_schema(ddl, docs.sparkSession)])

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode().translate(WORD_BYTES) for t in batch["_text"].to_pylist()]
            for first, last in chunks_of_bytes(texts):
                counts, owner, at, grams = gram_arrays(texts[first:last])
                own = np.arange(last - first)
                owner = np.concatenate([own, owner])
                rows = pa.array(owner + first)
                columns = [
                    batch["_id"].take(rows),
                    batch["_mark"].take(rows),
                    pa.array(counts[owner].astype(np.int64)),
                    pa.array(np.concatenate([np.full(len(own), -1), at]).astype(np.int64)),
                    pa.array(np.concatenate([np.zeros(len(own), np.int64), grams])),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


def _id_type(docs: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["_id"].dataType)


# ---- votes


def vote(grams: DataFrame, positions: DataFrame, found: list[Template]) -> DataFrame:
    """Per (_id, _mark): ``_n_words``, ``_copies`` (equal rows) and ``_spans``, the merged
    diagonals with enough votes: (template, low, high)."""
    matched = grams.join(F.broadcast(positions), "_gram", "left").where("_template IS NOT NULL OR _at = -1")
    row = ["_id", "_mark"]
    hits = matched.repartition(*row)
    # Copies of a row vote as often as they stand there.
    votes = hits.groupBy(*row, "_template", (F.col("_at") - F.col("_template_at")).alias("_diagonal")).agg(
        F.count(F.lit(1)).alias("_votes"), F.max("_n_words").alias("_n_words")
    )
    changed = F.element_at(F.array(*[F.lit(t.changed) for t in found]), F.col("_template") + 1)
    along = Window.partitionBy(*row, "_template").orderBy("_diagonal")
    apart = F.col("_diagonal") - F.lag("_diagonal").over(along) > changed
    islands = votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    islands = islands.withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy(*row, "_template", "_island").agg(
        F.sum("_votes").alias("_votes"), F.min("_diagonal").alias("_low"), F.max("_diagonal").alias("_high"), F.max("_n_words").alias("_n_words")
    )
    span = F.struct(F.col("_template").alias("template"), F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_votes").alias("votes"))
    per_row = merged.groupBy(*row).agg(
        F.max("_n_words").alias("_n_words"),
        F.max(F.when(F.col("_template").isNull(), F.col("_votes"))).alias("_copies"),
        F.collect_list(F.when(F.col("_template").isNotNull(), span)).alias("_spans"),
    )
    least = F.array(*[F.lit(t.least_votes) for t in found])
    enough = F.filter("_spans", lambda s: s["votes"] >= F.element_at(least, s["template"] + 1) * F.col("_copies"))
    return per_row.withColumn("_spans", F.array_sort(enough))


# ---- verification


def _near(sequence: list[bytes], template: Template) -> list[tuple[int, int, int]]:
    """Places (first, last + 1, changed) at which the template lies in the words with few
    enough changes: edit distance with a free start and end, the best end of each run."""
    n = len(template.words)
    steps = np.arange(n + 1)
    column, starts = steps.copy(), np.zeros(n + 1, np.int64)
    pattern = np.array(template.words, dtype=object)
    ends: list[tuple[int, int, int]] = []
    for j, word in enumerate(sequence):
        # Either the template's word meets this one, or this one is extra.
        met = column[:-1] + (pattern != word)
        new, begun = column + 1, starts.copy()
        new[0], begun[0] = 0, j + 1
        better = met <= new[1:]
        new[1:][better] = met[better]
        begun[1:][better] = starts[:-1][better]
        # Or words of the template are missing: running least of new - steps.
        lead = np.minimum.accumulate(new - steps)
        source = np.maximum.accumulate(np.where(new - steps == lead, steps, 0))
        column, starts = lead + steps, begun[source]
        if column[n] <= template.changed:
            ends.append((int(starts[n]), j + 1, int(column[n])))
    best: list[tuple[int, int, int]] = []
    for end in ends:
        if best and end[0] < best[-1][1]:
            if end[2] < best[-1][2]:
                best[-1] = end
        else:
            best.append(end)
    return best


def verify(text: str, spans: list[dict], found: list[Template]) -> list[dict]:
    """What really stands in the text: phrases in full, notices with few changed words. Of
    notices that lie on each other and differ in label the one with the best score stays."""
    sequence = words(text)
    phrases, notices = set(), set()
    for span in spans:
        template = found[span["template"]]
        n = len(template.words)
        if template.is_phrase:
            for first in range(span["low"], span["high"] + 1):
                if first >= 0 and tuple(sequence[first : first + n]) == template.words:
                    phrases.add((first, first + n, template.label, 1.0))
            continue
        begin = max(span["low"] - template.changed, 0)
        window = sequence[begin : span["high"] + n + template.changed]
        for first, last, changed in _near(window, template):
            notices.add((begin + first, begin + last, template.label, 1.0 - changed / n))
    kept = []
    for here in notices:
        better = (o for o in notices if o[2] != here[2] and o[0] < here[1] and here[0] < o[1])
        if all((o[3], o[1] - o[0]) < (here[3], here[1] - here[0]) for o in better):
            kept.append(here)
    rows = [(*p, True) for p in phrases] + [(*k, False) for k in kept]
    return [dict(zip(("first", "last", "label", "score", "is_phrase"), r)) for r in sorted(rows)]


SPANS = "array<struct<first:long,last:long,label:string,score:double,is_phrase:boolean>>"


@lru_cache(maxsize=8)
def _cached(phrases: tuple, notices: tuple) -> list[Template]:
    return templates(phrases, notices)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words`` and ``spans``: first word, last word + 1,
    label, score (share of the template's words that stand there) and whether it is a phrase.

    A null text is empty and has no spans; texts of any length are searched whole. Rows with a
    null id are told apart by their text. Repeated rows have equal results, one each. Equal
    places of two labels are both kept for phrases; among overlapping notices the best score
    wins, then the longer one, and equals drop out together. An empty table has no rows.
    Columns not named are ignored.
    """
    spark = docs.sparkSession
    pairs = tuple(map(tuple, phrases)), tuple(map(tuple, notices))
    found = _cached(*pairs)
    known = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col), F.octet_length(text_col)).alias("_mark"), F.col(text_col).alias("_text")
    )
    voted = written(vote(_grams(known), _positions(spark, found), found), "license-votes")
    none = F.array().cast(SPANS)
    clean = voted.where(F.size("_spans") == 0).select(
        "_id", "_n_words", none.alias("spans"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    )
    marked = voted.where(F.size("_spans") > 0).select(F.col("_id").alias("_other"), F.col("_mark").alias("_other_mark"), "_n_words", "_spans")
    same = F.col("_id").eqNullSafe(F.col("_other")) & (F.col("_mark") == F.col("_other_mark"))
    suspects = known.join(marked, same).select("_id", "_n_words", "_text", "_spans")
    arrow = pa.schema([pa.field("_id", _id_type(docs.select(F.col(id_col).alias("_id")))), *arrow_schema(f"_n_words long, spans {SPANS}", spark)])

    def check(batches):
        rules = _cached(*pairs)
        for batch in batches:
            spans = [verify(t, s, rules) for t, s in zip(batch["_text"].to_pylist(), batch["_spans"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_n_words"], pa.array(spans, arrow.field("spans").type)], schema=arrow)

    from pyspark.sql import types as T

    schema = T.StructType([known.schema["_id"], *T._parse_datatype_string(f"_n_words long, spans {SPANS}").fields])
    checked = suspects.mapInArrow(check, schema)
    every = clean.select("_id", "_n_words", "spans").unionByName(checked)
    return every.select(F.col("_id").alias(id_col), F.col("_n_words").alias("n_words"), "spans")


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``scan`` as counts: ``n_base`` places of phrases, ``first_word`` and ``last_word`` (their
    smallest and largest start), ``base_labels``, ``labels`` (notices too), ``score`` (best)."""
    found = scan(docs, id_col, text_col, **options)
    base = F.filter("spans", lambda s: s["is_phrase"])
    starts = F.transform(base, lambda s: s["first"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op13_license_scan(spark, directory):
    """Licenses named in every document."""
    return license_report(load(spark, directory, "documents"))


QUERIES = {"op13_license_scan": op13_license_scan}
ORACLES: dict[str, str] = {}
