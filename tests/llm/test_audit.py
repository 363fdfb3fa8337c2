"""Filter audit: every order replayed document by document."""

import collections
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def replay(documents, names):
    """``documents``: (part, failing names, good, toxic); every order applied to every document."""
    out, totals = {}, collections.Counter()
    for part in {d[0] for d in documents}:
        mine = [d for d in documents if d[0] == part]
        for order in itertools.permutations(names):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                failing = sum(f in d[1] for d in mine)
                left = [d for d in left if f not in d[1]]
                totals[part, f] += len(gone)
                out[part, "".join(order), step] = (len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in mine),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone))
    return sorted((*k, *v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def failing(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        flags = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and first.get(t, i) < i)
        out.append({f for f, x in zip("ABCDE", flags) if x})
    return out


def test_orders_through_the_lattice():
    for k in range(1, 6):
        edges = audit.lattice(k)
        assert len(edges) == k * 2 ** (k - 1)
        for s in range(1 << k):  # the orders that reach a state leave it
            into = sum(w for a, f, w in edges if a | 1 << f == s)
            assert into == (sum(w for a, _, w in edges if a == s) or math.factorial(k)) or s == 0
        for f in range(k):  # every order applies each filter once
            assert sum(w for _, g, w in edges if g == f) == math.factorial(k)
    assert len(audit.paths("ABCDE")) == 600 and len({p[0] for p in audit.paths("ABCDE")}) == 120


def test_documents_equal_replay(spark, docs, rows):
    rnd = random.Random(3)
    long = " ".join(f"w{i}" for i in range(250))
    more = [(500, long, None), (501, long, "en"), (502, long + " #", "en"), (503, long.upper(), "de"), (503, long.upper(), "de"),
            (504, "again " * 300, "en"), (None, long, "de"), (505, long, "")]
    extra = spark.createDataFrame(more, "doc_id long, text string, lang string")
    every = docs.unionByName(extra, allowMissingColumns=True)
    told = [(i, q, x) for i in range(0, 510) for q, x in [(rnd.choice([0, 1, None]), rnd.choice([0, 1, None]))]]
    told += [(501, 1, 0), (501, None, 1), (None, 1, 1)]
    labels = spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    good = {i for i, q, _ in told if q == 1 and i is not None}
    toxic = {i for i, _, x in told if x == 1 and i is not None}
    table = [r[:3] for r in rows] + more
    documents = [(r[2] or "", fails, r[0] in good, r[0] in toxic) for r, fails in zip(table, failing(table))]
    assert {f for d in documents for f in d[1]} == set("ABCDE") and any(len(d[1]) > 1 for d in documents)
    got = audit.audit_documents(every, labels)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == replay(documents, "ABCDE")


def test_any_table_and_filters(spark):
    rnd = random.Random(9)
    data = [(rnd.choice("xy"), *(rnd.choice([True, False, None]) for _ in range(3)), rnd.random() < .5) for _ in range(200)]
    df = spark.createDataFrame(data, "p string, a boolean, b boolean, c boolean, q boolean")
    cells = audit.flagged_cells(df, ["a", "b", "c"], "p", F.col("q"), ~F.col("q"))
    got = sorted(map(tuple, audit.audit(cells.repartition(7), "abc").collect()))
    assert got == replay([(r[0], {n for n, x in zip("abc", r[1:4]) if x}, r[4], not r[4]) for r in data], "abc")
    with pytest.raises(ValueError):
        audit.audit(cells, "abcdefgh")


def test_hot_text_and_empty_table(spark, no_docs):
    text = " ".join(f"w{i}" for i in range(200))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audit.audit_documents(df, labels)
    assert got.where("substr(filter_order, step, 1) = 'E' and removed = 2999 and kept = 1 and shapley = 2999 * 120").count() == 120
    assert got.where("good_lost + toxic_lost > 0").count() == 0
    assert audit.audit_documents(no_docs, labels).count() == 0
