"""Mixing: targets against a plain water-filling, totals near them, reruns agree."""

import collections
import re

import numpy as np

from cohortlens.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, cap=3.0, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest, weight = total - sum(cap * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * w[s] / weight for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_awkward_documents(docs, rows):
    out = mixing.mix(docs).collect()
    want = collections.Counter()
    for r in rows:
        want[r[3]] += len(WORD.findall(r[1] or ""))
    target = plain_targets(dict(want))
    assert sorted(((r.doc_id, r.source, r["size"]) for r in out), key=str) == sorted(
        ((r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows), key=str)
    taken = collections.Counter()
    for r in out:
        assert r.source_size == want[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.copies <= 3
        taken[r.source] += r["size"] * r.copies
    for s in want:  # one text makes up the long source: its fraction cannot be met nearer
        most = max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s)
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], most / 2 + 1), s
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_several_levels_of_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"s{int(i >= 400) + int(i >= 1000)}", " ".join("w" * int(rng.integers(1, 60)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(df, block=40).toPandas()
    per = out.assign(t=out["size"] * out.copies).groupby("source").agg(t=("t", "sum"), target=("target", "first"), n=("copies", "sum"),
                                                                       m=("copies", "size"), s=("source_size", "first"))
    assert (abs(per.t - per.target) <= 0.005 * per.target + 30).all()
    assert (abs(per.n - per.m * per.target / per.s) <= 0.02 * per.m + 3).all()  # the number of documents is balanced too


def test_flight_keeps_both_totals():
    size = np.random.default_rng(1).integers(0, 500, 800).astype(float)
    p = np.full(800, 0.37)
    q = mixing.fly(size, p)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs(size @ q - size @ p) < 1e-5 * (size @ p)


def test_mixed_rows_and_empty_table(docs, no_docs):
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and out.count() == mixing.mix(docs).selectExpr("sum(copies)").first()[0]
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
