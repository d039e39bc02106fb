"""Stages of the pipeline against plain versions of their rules, each on its own input."""

import random
import re
from collections import defaultdict

import corpus_pipeline
import pytest

DIRECTORY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in wheat river stone light paper north signal garden copper window letter quiet morning".split()


def frame(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def texts_with_copies():
    rnd = random.Random(12)
    base = [" ".join(rnd.choices(WORDS, k=rnd.randint(3, 120))) for _ in range(25)]
    out = list(base)
    for text in base[:15]:
        words = text.split()
        for changes in (0, 1, 2, 6):
            copy = list(words)
            for _ in range(changes):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            out.append(" ".join(copy).upper() if changes == 0 else " ".join(copy))
    passage = " ".join(rnd.choices(WORDS, k=40))
    out += [f"{rnd.choice(WORDS)} é {passage} ñ {rnd.choice(WORDS)}" for _ in range(4)]
    rnd.shuffle(out)
    return out


def test_near_duplicates_keep_one_of_each_group(spark):
    texts = texts_with_copies()
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_groups(spark, frame(spark, texts), DIRECTORY).collect()}
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert kept == {find(i) for i in range(len(texts))}
    assert len(kept) < len(texts)


def test_repeated_text_is_cut_once(spark):
    texts = texts_with_copies()
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_text(spark, frame(spark, texts), DIRECTORY).collect()}
    first = {}
    for i, text in enumerate(texts):
        raw = text.encode()
        for at in range(len(raw) - 49):
            first.setdefault(raw[at : at + 50], i)
    for i, text in enumerate(texts):
        raw = text.encode()
        gone = set()
        for at in range(len(raw) - 49):
            if first[raw[at : at + 50]] < i:
                gone.update(range(at, at + 50))
        left, place = "", 0
        for sign in text:
            size = len(sign.encode())
            # A character goes when all its bytes repeat.
            if not all(p in gone for p in range(place, place + size)):
                left += sign
            place += size
        if gone and not left.strip():
            assert i not in got
        else:
            assert got[i] == (left, len(left))


def test_benchmark_windows_remove_documents(spark):
    items = [r.text for r in spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()]
    texts = texts_with_copies()[:20] + [f"before {t} after" for t in items[:3]] + [" ".join(items[3].split()[:9]), items[4].upper()]
    kept = {r.doc_id for r in corpus_pipeline.benchmark_passages(spark, frame(spark, texts), DIRECTORY).collect()}

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))

    windows = defaultdict(set)
    for item in items:
        w = words(item)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[n].add(tuple(w[i : i + n]))
    want = set()
    for key, text in enumerate(texts):
        w = words(text)
        if not any(tuple(w[i : i + n]) in own for n, own in windows.items() for i in range(len(w) - n + 1)):
            want.add(key)
    assert kept == want and len(want) < len(texts)


@pytest.mark.parametrize("times", [1, 3])
def test_packing_holds_every_token_once(spark, times):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    texts = texts_with_copies() * times
    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    pieces = corpus_pipeline.packed_sequences(spark, frame(spark, texts), DIRECTORY).collect()
    own = defaultdict(list)
    for p in pieces:
        own[p.doc_id].append((p.start, p.length, p.doc_tokens))
    for i, text in enumerate(texts):
        size = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        at = 0
        for start, length, doc_tokens in sorted(own[i]):
            assert (start, doc_tokens) == (at, size)
            at += length
        assert at == size
