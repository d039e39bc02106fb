"""A text of several MB through every operator on documents."""

import hashlib
import random

import pytest

from tidemark.llm import (
    decontamination,
    language_id,
    language_model,
    license_scan,
    matroska,
    merkle,
    near_duplicates,
    packing,
    sharding,
    suffix_array,
    token_counts,
)

WORDS = "the of and to in wheat river stone light paper north signal garden copper window letter quiet morning".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", ",", str(rnd.randint(0, 9))]) for _ in range(n))


LONG = prose(8, 500_000)
TEXTS = [LONG, LONG[: len(LONG) // 2] + "\n" + prose(9, 1000), "a" * 3_000_000, "short text", None]


@pytest.fixture(scope="module")
def long_docs(spark):
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).persist()


@pytest.mark.parametrize("size", [262_656, 262_657, 263_232, 3_000_000])
def test_media_of_every_length(size):
    payload = bytes(range(256)) * (size // 256) + b"x" * (size % 256)
    payload += b"\xff" * (-len(payload) % 576)
    parsed = matroska.parse(data := matroska.mux(payload))
    assert b"".join(data[p.start : p.start + p.length] for p in parsed.packets) == payload
    times = [p.timestamp for p in parsed.packets if not p.frame]
    assert times == sorted(times) and len(parsed.cues) == parsed.clusters
    with pytest.raises(ValueError):
        matroska.block(1, 32_768, [b"x"], matroska.NO_LACING)


def test_media(long_docs):
    got = {r.doc_id: (r.n_bytes, r.payload_sha256) for r in matroska.media_digest(matroska.media_column(long_docs)).collect()}
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        assert got[i] == (len(raw), hashlib.sha256(payload).hexdigest())


def test_near_duplicates_and_repeats(long_docs):
    kept = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(long_docs).collect()}
    assert kept == {i: i for i in range(5)}
    cut = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_array.remove_repeats(long_docs).collect()}
    half = len(LONG) // 2
    assert cut[0] == (len(LONG), 0) and cut[1][1] >= half and cut[4] == (0, 0)


def test_counts_and_scores(long_docs):
    tokens = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(long_docs).collect()}
    assert tokens[0] > 400_000 and tokens[4] == 0
    from pyspark.sql import functions as F

    scores = {r.doc_id: r for r in language_model.score_texts(long_docs, F.col("doc_id") != 1).collect()}
    assert scores[0].n_tokens == len(LONG.split()) + 1 and scores[0].score < scores[3].score
    pieces = packing.pack_documents(long_docs).collect()
    for i in range(5):
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == i)
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def test_rows_of_the_others(spark, long_docs):
    benchmark = spark.createDataFrame([(1, " ".join(LONG.split()[400_000:400_012]))], "item_id long, text string")
    hit = {r.doc_id: r.contaminated for r in decontamination.contamination_report(long_docs, benchmark).collect()}
    assert hit == {0: True, 1: False, 2: False, 3: False, 4: False}
    assert language_id.identify(long_docs, long_docs).count() == 5
    assert sharding.assign_shards(long_docs).count() == 5
    assert license_scan.scan(long_docs).where("n_words >= 500000").count() == 1
    assert merkle.manifest(long_docs, merkle.COLUMNS).select("root").distinct().count() == 1
