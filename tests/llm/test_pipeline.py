"""The stages of the pipeline on a small table."""

import random

import corpus_pipeline

DIRECTORY = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_filter_and_keep_columns(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    kept = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIRECTORY).persist()
        assert docs.columns == COLUMNS, name
        left = {r.doc_id for r in docs.collect()}
        assert left and left <= kept, name
        kept = left
    pieces = corpus_pipeline.packed_sequences(spark, docs, DIRECTORY).collect()
    assert {r.doc_id for r in pieces} == kept


def test_language_with_vowel_signs_stays(spark):
    """Clean labelled Hindi stays beside English; signs that no language parses go."""
    hindi = "यह किताब मेरे दोस्त की है और हम हर दिन स्कूल में हिन्दी पढ़ते हैं क्योंकि भाषा बहुत सुन्दर लगती है".split()
    english = "this book belongs to my friend and every morning we read letters from the garden school".split()
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(hindi if i % 2 else english, k=25)), "hi" if i % 2 else "en", "s", 1) for i in range(120)]
    rows.append((1000, "Ж Щ " * 40, None, "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, DIRECTORY).collect()}
    assert kept == set(range(120))


def test_odd_rows_pass_every_stage(spark, docs):
    rows = docs.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, DIRECTORY)
    assert rows.count() > 0


def test_run_on_no_rows(spark, no_docs):
    rows = no_docs.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, DIRECTORY)
    assert rows.count() == 0
