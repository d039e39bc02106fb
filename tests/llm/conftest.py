"""Small documents with every odd case, shared by the tests of this folder."""

import random

import pytest

WORDS = "the of and to in wheat river stone light paper north signal garden copper window letter quiet morning".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, node string"


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", ",", str(rnd.randint(0, 9))]) for _ in range(n))


def sample_rows():
    base = [prose(i, 40 + 5 * i) for i in range(12)]
    texts = [
        *base,
        base[3],
        base[3],
        base[4] + " one more end",
        base[5][:200] + " changed here " + base[5][200:],
        prose(99, 30) + " " + base[6][20:180] + " " + prose(98, 30),
        None,
        "",
        " \t\n",
        "ééé ñandú " * 30,
        "a" * 3000,
        "*** 123 $$$",
        "Tiny",
        prose(7, 9000),
    ]
    rows = [(i * 3, t, "en" if i % 2 else "xx", f"src{i % 3}", len(t or ""), "clash", "clash", None) for i, t in enumerate(texts)]
    rows.append(rows[2])  # a repeated row
    rows.append((None, base[7], None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
