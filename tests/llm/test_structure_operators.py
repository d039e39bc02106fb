"""Merkle manifest, conversation repair and license scan against plain versions."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import license_scan, merkle, repair

# ---- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, arity=3):
    """Root and, for each leaf, its siblings per level as (left, right)."""
    level, proofs = list(leaves), [[] for _ in leaves]
    owners = [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, held = [], []
        for at in range(0, len(level), arity):
            run = level[at : at + arity]
            for slot, under in enumerate(owners[at : at + arity]):
                for leaf in under:
                    proofs[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            above.append(sha("".join(run)))
            held.append([leaf for under in owners[at : at + arity] for leaf in under])
        level, owners = above, held
    return level[0], proofs


def plain_manifest(rows, columns):
    """Counter of (id, leaf, subroot, root, proof)."""

    def leaf(row):
        return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))

    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        nodes = sorted(groups[name])
        trees.append((nodes, *plain_tree([d for *_, d in nodes])))
    root, above = plain_tree([t[1] for t in trees])
    out = Counter()
    for (nodes, subroot, proofs), upper in zip(trees, above):
        for (known, key, digest), proof in zip(nodes, proofs):
            out[key if known else None, digest, subroot, root, tuple(proof + upper)] += 1
    return out


def collected(found):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in found.collect())


@pytest.mark.parametrize("block_levels", [1, 2, 7])
def test_manifest_is_that_of_a_plain_tree(spark, docs, rows, block_levels):
    """Null ids, groups and texts, repeated rows, a very long text; one and many layers."""
    named = [r.asDict() for r in docs.collect()]
    found = merkle.manifest(docs, merkle.COLUMNS, block_levels=block_levels)
    assert collected(found) == plain_manifest(named, merkle.COLUMNS)


def test_manifest_of_a_hot_group(spark):
    """One group with most rows, many groups of one: several layers in both trees."""
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    rows = [(i * 7 % 1000, "hot", None, i, f"text {i}") for i in range(500)]
    rows += [(i, f"s{i}", "en", 1, "x") for i in range(60)] + [(3, "é", None, None, None), (4, "", None, None, "\n")]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    found = merkle.manifest(docs, merkle.COLUMNS, block_levels=2)
    assert collected(found) == plain_manifest([r.asDict() for r in docs.collect()], merkle.COLUMNS)


def test_folding_shows_what_changed(spark):
    rows = [(i, f"s{i % 3}", f"line {i}\nnext") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    other = F.when(F.col("doc_id") == 17, F.lit("forged")).otherwise(F.col("text"))
    claim = merkle.leaf_digest([F.col("doc_id"), F.col("source"), other])
    found = merkle.manifest(docs, ["doc_id", "source", "text"], claims={"claim": claim}, block_levels=1)
    wrong = found.where(merkle.fold(F.col("claim"), F.col("proof")) != F.col("root")).collect()
    assert [r.doc_id for r in wrong] == [17]
    assert found.where(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 40


def test_manifest_of_no_rows_and_one_row(spark, no_docs):
    assert merkle.manifest(no_docs, merkle.COLUMNS).count() == 0
    one = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    row = merkle.manifest(one, ["doc_id", "source"]).first()
    assert row.leaf == row.subroot == row.root == sha("1:11:a") and row.proof == []


# ---- conversation repair


def plain_repair(symbols):
    """Least (cost, audit) by trying edits row by row over the states of the pattern."""
    inserts = {0: [(0, 0, ""), (2, 3, "I"), (3, 6, "II")], 1: [(1, 0, ""), (2, 3, "I"), (3, 6, "II")],
               2: [(2, 0, ""), (3, 3, "I"), (2, 6, "II")], 3: [(3, 0, ""), (2, 3, "I"), (3, 6, "II")]}
    moves = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {0: (0, "")}
    for symbol in symbols:
        after = {}
        for state, (cost, audit) in best.items():
            for mid, more, letters in inserts[state]:
                edits = [(mid, 4, "D")]
                extra = 3 if symbol.isupper() else 0
                for initial in "sua":
                    target = moves.get((initial, mid))
                    if symbol == "x" or target is None:
                        continue
                    if symbol.lower() == initial:
                        edits.append((target, extra, "K"))
                    if initial != "s":
                        edits.append((target, 3 + extra, "R"))
                for target, price, letter in edits:
                    whole = (cost + more + price, audit + letters + letter)
                    after[target] = min(whole, after.get(target, whole))
        best = after
    ends = [(c + more, a + letters) for s, (c, a) in best.items() for t, more, letters in inserts[s] if t in (0, 3)]
    return min(ends)


def test_chart_of_all_short_conversations():
    for n in range(4):
        for symbols in itertools.product("suaoSUAOx", repeat=n):
            assert repair.cheapest(repair.parse("".join(symbols))) == plain_repair(symbols), symbols


def test_chart_of_long_conversations():
    rnd = random.Random(8)
    for n in (15, 16, 17, 33, 70, 300):
        symbols = "".join(rnd.choice("suauauauaUAox") for _ in range(n))
        assert repair.cheapest(repair.parse(symbols)) == plain_repair(symbols)


def plain_conversations(rows):
    """rows (conv_id, turn, role, text) to the columns of the report."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        held[conv].append((turn is not None, turn or 0, role.encode(), mark, role, text))
    out = {}
    for conv, turns in held.items():
        turns.sort()
        seen, symbols, counts = set(), "", Counter()
        for *_, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            symbol = role[:1] if role[:1] in tuple("sua") else "o"
            symbols += {"": symbol, "truncated": symbol.upper()}.get(fault, "x")
        initials = [t[4][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = plain_repair(symbols)
        lines, state, at = [], "", 0
        for letter in audit:
            role = "assistant" if state == "u" else "user"
            if letter == "I":
                lines.append(f"{role}:")
                state = role[0]
                continue
            own, text = turns[at][4], turns[at][5]
            at += 1
            if letter == "D":
                continue
            if letter == "K":
                role = own
            lines.append(f"{role}:{text}")
            state = role[0]
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines)))
    return out


TALK = "conv_id long, turn long, role string, text string, extra string, key string, digest string"


def talk():
    rnd = random.Random(3)
    rows = []
    for conv in range(40):
        for turn in range(rnd.choice([1, 2, 4, 7, 40])):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice([f"Turn {turn}.", f"Turn {turn}.", "Same words!", "cut off", " \t\n", "", None, "é?\x0b "])
            rows.append((conv if conv else None, rnd.choice([turn, turn, turn, None, 3]), role, text))
    rows += rows[5:9]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"Line {t}. " + "y" * 50) for t in range(400)]
    rows += [(101, 1, "user", "Again.")] * 300 + [(102, 0, "user", "long. " * 300_000)]
    return rows


@pytest.mark.parametrize("partitions", [None, 7])
def test_repair_of_conversations(spark, partitions):
    """Nulls, ties, repeated rows, long conversations cut over tasks, a long text."""
    rows = talk()
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TALK).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(frame, partitions=partitions).collect()}
    assert got == plain_conversations(rows)


def test_repair_without_rows(spark):
    empty = spark.createDataFrame([], TALK)
    assert repair.repair(empty).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "Hi.", "", "", "")], TALK)
    row = repair.repair(gone, copies=F.lit(0)).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", sha(""))


# ---- license scan

NOTICE = next(text for label, text in license_scan.NOTICES if label == "bsd")


def plain_places(text, template):
    """Whether the template lies in the text with few enough changed words."""
    sequence, n = license_scan.words(text), len(template.words)
    column = list(range(n + 1))
    least = column[n]
    for word in sequence:
        before, column = column, [0]
        for i in range(n):
            column.append(min(before[i] + (template.words[i] != word), before[i + 1] + 1, column[i] + 1))
        least = min(least, column[n])
    return least <= template.changed, least


def licensed_rows():
    rnd = random.Random(11)
    parts = [t for _, t in license_scan.PHRASES + license_scan.NOTICES]
    texts = []
    for i in range(120):
        chosen = rnd.sample(parts, rnd.randint(0, 2))
        mixed = [" ".join(rnd.choices(["the", "license", "is", "under", "wheat", "version", "software", "public"], k=rnd.randint(0, 30)))]
        for text in chosen:
            changed = text.split(" ")
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randrange(len(changed))
                changed[at : at + rnd.randint(0, 1)] = rnd.choice([[], ["zebra"]])
            mixed += [" ".join(changed), " ".join(rnd.choices(["river", "of", "the"], k=rnd.randint(0, 9)))]
        texts.append("\n".join(mixed))
    texts += [None, "", "cc", "by nc", "CC-BY/NC", "cc by nc cc by nc", "É under THE mit, License!", NOTICE + " word " * 200_000 + NOTICE]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[5], rows[5], (None, "under the MIT license", "", ""), (None, "nothing", "", ""), (None, None, "", "")]


@pytest.fixture(scope="module")
def licensed(spark):
    return spark.createDataFrame(licensed_rows(), "doc_id long, text string, label string, spans string").repartition(3)


def test_phrases_are_all_found(licensed):
    want = Counter()
    for key, text, *_ in licensed_rows():
        sequence = license_scan.words(text)
        starts = [(i, label) for label, phrase in license_scan.PHRASES for i in range(len(sequence))
                  if sequence[i : i + len(phrase.split())] == phrase.encode().split()]
        labels = ",".join(sorted({label for _, label in starts}))
        want[key, len(sequence), len(starts), min(starts)[0] if starts else None, max(starts)[0] if starts else None, labels] += 1
    got = license_scan.license_report(licensed).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want


def test_notices_with_changed_words_are_found(licensed):
    found = license_scan.templates()
    texts = {r[0]: r[1] for r in licensed_rows() if r[0] is not None}
    for row in license_scan.scan(licensed).where("doc_id IS NOT NULL").collect():
        best = {}
        for template in found:
            near, changed = plain_places(texts[row.doc_id], template) if len(texts[row.doc_id] or "") < 5000 else (False, 0)
            if near and not template.is_phrase:
                best[template.label] = max(best.get(template.label, 0), 1 - changed / len(template.words))
        labels = {s.label for s in row.spans if not s.is_phrase}
        if len(texts[row.doc_id] or "") >= 5000:
            assert labels == {"bsd"} and len(row.spans) == 2
            continue
        assert labels <= set(best)
        # Only a better notice on the same words may take the place of one.
        for label in set(best) - labels:
            assert any(s.score >= best[label] for s in row.spans), (row.doc_id, label)
        for span in row.spans:
            assert span.is_phrase or span.score <= best[span.label]


def test_scan_of_no_rows(no_docs):
    assert license_scan.scan(no_docs).count() == 0
