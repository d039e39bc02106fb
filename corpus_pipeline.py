"""Documents to training sequences in five stages, each an operator of ``tidemark.llm``.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``, the last
one pieces of packed sequences. ``run`` writes each stage as Parquet below the shared folder
and reads it back, so a lost executor costs at most one stage's tasks.

Rows with null or empty texts and rows with a null id pass the stages by the rules that the
operators state; the language stage removes texts without a letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, written
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.language_id import FOLDS, UNKNOWN, fold, identify
from tidemark.llm.near_duplicates import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.suffix_array import remove_repeats

# A text whose best language needs this many times the phrases per letter that the labelled
# texts of that language need, and more than nearly all of them, is in none.
TIMES_USUAL = 2.4
NEARLY_ALL = 0.99


def language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: texts without a letter, and texts that no learned language
    parses, are rejected. Languages are learned outside the held-out fold of these rows, and
    each is measured by all rows with its label."""
    labelled = docs.where(F.coalesce(fold("doc_id", FOLDS), F.lit(-1)) > 0)
    found = identify(docs, labelled, prefix="_language_")
    found = written(found.where(F.col("_language_lang_pred") != UNKNOWN), "languages")
    rates = F.percentile_approx("_language_phrase_rate", F.array(F.lit(0.5), F.lit(NEARLY_ALL)), 10_000)
    usual = found.where(F.col("lang").isNotNull()).groupBy(F.col("lang").alias("_language_label")).agg(rates.alias("_language_rates"))
    most = F.greatest(F.lit(TIMES_USUAL) * F.col("_language_rates")[0], F.col("_language_rates")[1])
    judged = found.join(F.broadcast(usual), F.col("_language_lang_pred") == F.col("_language_label"), "left")
    parsed = F.coalesce(F.col("_language_phrase_rate") <= most, F.lit(True))
    return judged.where(parsed).select(*docs.columns)


def near_duplicate_groups(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept").select("doc_id").distinct()
    known = docs.join(kept.hint("merge"), "doc_id", "left_semi")
    return known.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def repeated_text(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller id also has are cut out, in whole characters.
    Documents of which nothing is left go; ``n_chars`` follows the text."""
    cut = remove_repeats(docs, with_text=True, prefix="_repeats_")
    changed = F.col("_repeats_n_removed") > 0
    left = cut.where(~changed | (F.trim("text") != ""))
    text_length = F.length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(changed, text_length).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def benchmark_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs are removed."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def packed_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of sequences of 4096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate_groups),
    ("repeated_text", repeated_text),
    ("decontamination", benchmark_passages),
    ("packing", packed_sequences),
]

ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` of ``sf_dir``; the rows of the last one."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
