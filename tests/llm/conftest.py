"""Documents with every awkward case: nulls in any column, empty and very long texts, ties,
repeated rows, and extra columns whose names clash with those the operators use inside."""

import random

import pytest

CLASHING = ["digest", "fp", "host", "size", "copies", "n", "ids", "h", "at", "key", "vec", "bytes", "shard", "_d", "_g", "k1"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def words(rnd, n, vocabulary=400):
    return " ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randrange(vocabulary)) for _ in range(n))


def document_rows():
    rnd = random.Random(5)
    rows = []

    def add(i, text, lang="en", source="s0"):
        rows.append((i, text, lang, source, None if text is None else len(text), *["x"] * len(CLASHING)))

    base = [words(rnd, 120) for _ in range(12)]
    for i, t in enumerate(base):
        add(i, t, source=f"s{i % 3}")
    for i in range(6):  # near copies: a word or two changed
        t = base[0].split()
        t[10 * i] = "changed"
        add(20 + i, " ".join(t))
    for i in range(5):  # exact copies
        add(30 + i, base[1])
    passage = words(rnd, 60)
    for i in range(4):  # a passage in different texts
        add(40 + i, words(rnd, 70 + i) + "\n" + passage + "\n" + words(rnd, 50), source=None)
    line = "The same line in many texts, again and again"
    for i in range(14):
        add(60 + i, words(rnd, 60) + "\n" + line.upper() + "  \n" + line + "\nlast " + str(i), source="s1")
    add(80, None)
    add(81, "")
    add(82, " \n\t \r\n")
    add(83, "one two", lang=None)
    add(84, "a b c d a b c d a b c " * 10)
    add(85, words(rnd, 60_000, 50), source="long")  # very long
    add(86, "12345 67 !!! ###")
    add(87, "É" * 150 + " ünïcödé " * 40)
    add(88, "ab" * 400)  # periodic
    add(None, base[2])
    add(None, None, lang=None, source=None)
    add(3, base[3])  # a repeated row
    rows.append(rows[-1])
    return rows


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
