"""Operators without an exchange, against plain versions of their rules."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontamination, language_id, matroska, packing, token_counts
from tidemark.llm.matroska import block, lace, parse, unlace


def text_of(rows):
    return [(r[0], r[1] or "") for r in rows]


def by_id(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


# ---- token counts


def test_counts_are_those_of_the_library(docs, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    want = Counter((k, len(t.encode()), n := len(model.encode(t)), n > 100) for k, t in text_of(rows))
    got = token_counts.count_tokens(docs, limit=100).collect()
    assert by_id(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_counts_of_random_signs():
    merger = token_counts.merger(public_tokenizers.path(token_counts.MODEL))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    rnd = random.Random(5)
    for _ in range(500):
        text = "".join(rnd.choice("ab then  \n\t.,é▁ñ漢<s></s>0\x00　ﬁ🙂") for _ in range(rnd.randint(0, 50)))
        assert merger.count(text) == len(model.encode(text)), text


def test_counts_of_no_rows(no_docs):
    assert token_counts.count_tokens(no_docs).count() == 0


# ---- Matroska


def test_media_round_trip(docs, rows):
    got = matroska.media_digest(matroska.media_column(docs)).collect()
    want = []
    for key, text in text_of(rows):
        raw = text.encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        want.append((key, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    assert by_id(got, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == Counter(want)


@pytest.mark.parametrize("kind", [matroska.XIPH_LACING, matroska.FIXED_LACING, matroska.EBML_LACING])
def test_lacing_round_trip(kind):
    rnd = random.Random(kind)
    for _ in range(100):
        frames = [rnd.randbytes(rnd.randint(0, 700)) for _ in range(rnd.randint(2, 20))]
        if kind == matroska.FIXED_LACING:
            frames = [rnd.randbytes(30) for _ in frames]
        body = lace(frames, kind)
        assert [body[a : a + n] for a, n in unlace(body, 0, len(body), kind)] == frames


def test_unknown_sizes_and_cues():
    unknown = b"\x01" + b"\xff" * 7

    def cluster(time, frames):
        body = matroska._number(matroska.CLUSTER_TIME, time) + block(2, 5, frames, matroska.EBML_LACING, simple=False)
        return matroska.CLUSTER.to_bytes(4, "big") + unknown + body

    data = matroska._element(matroska.EBML, b"") + matroska.SEGMENT.to_bytes(4, "big") + unknown
    data += cluster(10, [b"abc", b"d"]) + cluster(20, [b"ef"]) + matroska._element(matroska.CUES, b"")
    packets = parse(data).packets
    assert [(p.track, p.timestamp, data[p.start : p.start + p.length]) for p in packets] == [(2, 15, b"abc"), (2, 15, b"d"), (2, 25, b"ef")]


def test_packet_table_keeps_broken_media_as_errors(spark, docs):
    media = matroska.media_column(docs.where("doc_id = 3")).select("doc_id", "media")
    broken = spark.createDataFrame([(1, bytearray(b"\x00bad")), (2, None)], "doc_id long, media binary")
    table = matroska.packet_table(media.union(broken)).collect()
    assert [r.doc_id for r in table if r.error] == [1]
    assert {r.track for r in table if not r.error} == {1}


# ---- packing


def test_pieces_cover_every_document(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces = packing.pack_documents(docs, capacity=256, piece=64, block_tokens=3000).toPandas()
    for key, text in text_of(rows):
        if key is None or [k for k, _ in text_of(rows)].count(key) > 1:
            continue
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        own = pieces[pieces.doc_id == key].sort_values("start")
        assert set(own.doc_tokens) == {len(ids)} and own.length.sum() == len(ids)
        for start, length, crc in zip(own.start, own.length, own.ids_crc32):
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.length.sum() <= 256
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]]


def test_ids_are_those_of_the_library():
    path = public_tokenizers.path(packing.TOKENIZER)
    whole, own = Tokenizer.from_file(path), packing.tokenizer(path)
    signs = ["a", "B", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "é", "É", "é", "Σ", "İ", " ", "\n", "\t", "1", ".", "!", "漢", "\x1c", "ß"]
    rnd = random.Random(2)
    for _ in range(1000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12)))
        assert own.ids([text])[0] == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_windows_rise_when_capacity_is_exceeded():
    rnd = random.Random(1)
    for _ in range(200):
        sizes = [rnd.randint(1, 100) for _ in range(rnd.randint(1, 60))]
        groups = packing.pack(sizes, 100)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in g) for g in groups) <= 100


def test_differencing_is_near_equal():
    rnd = random.Random(3)
    sizes = [rnd.randint(1, 1000) for _ in range(400)]
    sums = [sum(sizes[i] for i in g) for g in packing.difference(sizes, 20)]
    assert max(sums) - min(sums) < 20


def test_packing_of_no_rows(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


# ---- decontamination


def plain_hits(text, items, window):
    words = decontamination.words(text)
    hit, keys = set(), set()
    for key, item in items:
        item = decontamination.words(item)
        n = min(window, len(item))
        grams = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
                keys.add(key)
    return len(words), len(hit), len(keys), hashlib.sha256(",".join(sorted(keys)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 150])
def test_hits_of_all_windows(spark, docs, rows, block_bytes):
    items = [("1", rows[1][1][40:200]), ("2", "the of and"), ("3", "River STONE"), ("30", rows[6][1]), ("4", ""), ("5", None), ("6", "ñandú")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.contamination_report(docs, benchmark, window=4, block_bytes=block_bytes).collect()
    want = Counter((k, *plain_hits(t, [(a, b or "") for a, b in items], 4)) for k, t in text_of(rows))
    assert by_id(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def test_passages_are_cut_and_documents_dropped(spark):
    docs = spark.createDataFrame([(1, "x y ONE two three, z", 5), (2, "one two three", 5), (3, "none of it", 5)], "doc_id long, text string, n_words int")
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, benchmark, max_coverage=0.6).collect()}
    assert cut == {1: "x y , z", 3: "none of it"}
    kept = decontamination.decontaminate(docs, benchmark).collect()
    assert [(r.doc_id, r.n_words) for r in kept] == [(3, 5)]


def test_no_benchmark_is_no_hit(spark, docs, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination_report(docs, nothing).where("contaminated").count() == 0
    assert decontamination.contamination_report(no_docs, nothing).count() == 0


# ---- languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.97


def test_odd_texts_are_unknown(docs, rows):
    got = language_id.identify(docs, docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= float(r.score) <= 1


def test_nothing_learned_is_unknown(docs, no_docs):
    assert {r.lang_pred for r in language_id.identify(docs, no_docs).collect()} == {"und"}
    assert language_id.identify(no_docs, docs).count() == 0


def test_phrases_are_longest_matches():
    rnd = random.Random(4)
    for _ in range(100):
        known = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(5)]
        held = {f" {w} "[i:j] for w in known for i in range(len(w) + 2) for j in range(i + 1, len(w) + 3)}
        automaton = language_id.WordAutomaton(known)
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 8)))
        text, count = f" {word} ", 0
        while text:
            n = max((i for i in range(1, len(text) + 1) if text[:i] in held), default=1)
            text, count = text[n:], count + 1
        assert automaton.phrases(word) == count
