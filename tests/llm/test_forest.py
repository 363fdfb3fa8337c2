"""Hash-prefix forest: recall against brute force, exact scores, awkward vectors."""

import numpy as np

from cohortlens.llm import forest


def brute(ids, x, k):
    out = {}
    for j in np.flatnonzero(np.array(ids) % 20 == 0):
        s = [float(np.dot(v, x[j])) for v in x]
        out[ids[j]] = sorted((-s[i], ids[i]) for i in range(len(ids)) if ids[i] != ids[j])[:k]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 32)) * rng.uniform(0.5, 2, (3000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in forest.nearest(df, df.where("vec_id % 20 = 0"), candidates=3000, shard_rows=1024, query_block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = []
    for q, want in brute(list(range(3000)), x, 20).items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - np.dot(x[v], x[q])) < 1e-12 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        hits.append(len({v for _, v, _ in mine} & {v for _, v in want}) / 20)
    assert np.mean(hits) >= 0.9


def test_recall_with_production_parameters_on_uneven_norms(spark):
    rng = np.random.default_rng(1)
    for name, norms in (("lognormal", rng.lognormal(0, 1, 8192)), ("one long", np.where(np.arange(8192) == 7, 5.0, 1.0))):
        x = rng.standard_normal((8192, 64))
        x *= (norms / np.linalg.norm(x, axis=1))[:, None]
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = {}
        for r in forest.nearest(df, df.where("vec_id % 200 = 0")).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        exact = x[::200] @ x.T
        exact[np.arange(len(exact)), np.arange(0, 8192, 200)] = -np.inf
        hits = [len(got[200 * j] & set(np.argsort(-s)[:20].tolist())) / 20 for j, s in enumerate(exact)]
        print(name, "recall", round(float(np.mean(hits)), 3), "worst", min(hits))
        assert np.mean(hits) >= 0.95 and min(hits) >= 0.75


def test_equal_and_awkward_vectors(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(100)] + [(100 + i, [float(i % 7), -1.0, float(i % 3) + 0.25]) for i in range(40)]
    bad = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [float("nan"), 1.0, 1.0]), (280, [1.0, float("inf"), 0.0]),
           (300, []), (320, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (0, [1.0, 2.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<double>, vec string, shard int")
    got = [tuple(r) for r in forest.nearest(df, df.where("vec_id % 20 = 0")).collect()]
    want = brute([i for i, _ in rows], np.array([v for _, v in rows]), 20)
    assert sorted((q, v, round(s, 12)) for q, _, v, s in got) == sorted((q, v, round(-s, 12)) for q, r in want.items() for s, v in r)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [3.0])], "vec_id long, embedding array<double>")
    assert forest.nearest(few, few.where("vec_id % 20 = 0")).count() == 4  # all candidates, if fewer than k
    assert forest.nearest(df.limit(0), df.limit(0)).count() == 0
