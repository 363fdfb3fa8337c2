"""Centroid clustering against exact integer arithmetic in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from cohortlens.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, n string, keys string"


def brute(rows, k, rounds, dim=64, scale=64):
    kept = [(r[0], [math.floor(scale * x) for x in r[1]]) for r in rows
            if r[1] is not None and len(r[1]) == dim and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted((i for i in kept if i[0] is not None), key=lambda i: (hashlib.sha256(f"1:{i[0]}".encode()).hexdigest(), i[1]))
    order += sorted((i for i in kept if i[0] is None), key=lambda i: i[1])
    marks = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(marks))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        marks = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(marks)]
    told = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = {}
    for _, j, d in told:
        per[j] = per.get(j, 0) + d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in marks]
    return sorted(((i, j, d, per[j], sum(per.values()), name[j]) for i, j, d in told), key=str)


def vectors(n, seed=4):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + rnd.gauss(0, .1) for x in rnd.choice(middle)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * 63), (n + 3, [None] + [1.0] * 63), (n + 4, [float("nan")] * 64),
             (n + 5, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (n + 6, [0.0] * 64), (n + 7, [-0.0] * 64), (n + 8, [-1e4] * 64)]
    return rows + [rows[0], rows[0], (1, rows[2][1])]


@pytest.mark.parametrize("block", [7, 2048])
def test_equals_exact_arithmetic(spark, block):
    rows = vectors(300)
    df = spark.createDataFrame([(*r, 1, "c", "n", "k") for r in rows], SCHEMA).repartition(3)
    got = centroids.cluster(df, block=block)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 16, 3)


def test_few_vectors_ties_and_empty(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(9)]  # equal centroids: the smaller number wins, the others stay empty
    got = centroids.cluster(spark.createDataFrame(rows, "vec_id int, embedding array<float>"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 16, 3)
    for bad in ([], [(1, None)], [(1, [1.0])]):
        assert centroids.cluster(spark.createDataFrame(bad, "vec_id long, embedding array<double>")).count() == 0
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")).count()


def test_tables_are_distances():
    rnd = np.random.default_rng(3)
    x, marks = rnd.integers(-50, 50, (200, 6)), rnd.integers(-50, 50, (5, 6))
    found = [np.unique(x[:, d], return_inverse=True) for d in range(6)]
    t = centroids.Tables(200, np.concatenate([v for v, _ in found]).tobytes(), np.cumsum([len(v) for v, _ in found]).astype(np.int32).tobytes(),
                         np.stack([c for _, c in found]).astype(np.uint16).tobytes())
    want = ((x[:, None] - marks[None]) ** 2).sum(axis=2)
    assert (t.distances(marks) == want).all()
    near = want.argmin(axis=1)
    assert (t.sums(near, 5) == np.stack([x[near == j].sum(axis=0) for j in range(5)])).all()
