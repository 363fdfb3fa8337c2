"""Embedding near-duplicates against all cosines in double precision."""

import numpy as np
import pytest

from cohortlens.llm import neardup

SCHEMA = "vec_id long, embedding array<{}>, label int, v string, n string, band string"


def near(rng, x, cosine):
    """A vector with the given cosine to x."""
    y = rng.standard_normal(len(x))
    y -= (y @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


def planted(n, seed=1, dim=64, group=120):
    rng = np.random.default_rng(seed)
    rows = list(rng.standard_normal((n, dim)))
    for i in range(0, n // 4, 2):
        rows.append(near(rng, rows[i], rng.uniform(.86, .999)))
    rows += [near(rng, rows[1], .99) for _ in range(group)]  # one large group of near copies
    rows += [rows[3]] * 30                                     # and one of copies
    return rows


def links(vectors, threshold=.9):
    u = np.array(vectors, np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    out = u @ u.T >= threshold
    np.fill_diagonal(out, False)
    return out


def classes(found):
    name = np.arange(len(found))
    while True:
        new = np.minimum(name, np.where(found, name[None], len(found)).min(axis=1))
        if (new == name).all():
            return name
        name = new


@pytest.mark.parametrize("block", [neardup.BLOCK, 60])
def test_links_and_classes(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)  # 60: the group's bucket is settled in pairs of blocks
    vectors = planted(1500)
    df = spark.createDataFrame([(i, x.tolist(), 0, "v", "n", "b") for i, x in enumerate(vectors)], SCHEMA.format("double"))
    got = {r.vec_id: r for r in neardup.near_duplicates(df.repartition(5)).collect()}
    found = links(vectors)
    assert len(got) == len(vectors) and found[1].sum() >= 120
    told = np.array([got[i].n_links for i in range(len(vectors))])
    assert (told <= found.sum(axis=1)).all() and told.sum() >= .995 * found.sum()  # no link too many, hardly one lost
    sure = links(vectors, .95).sum(axis=1)
    assert (told >= sure).all()
    name, low = classes(found), classes(links(vectors, .95))
    for i in range(len(vectors)):
        assert name[i] <= got[i].component_id <= low[i] and got[i].kept == (got[i].component_id == i)


def test_estimates_rule_no_link_out_and_most_others():
    rng = np.random.default_rng(5)
    u = neardup.unit(rng.standard_normal((2000, 64)))
    w = np.array([near(rng, x, .9) for x in u])
    a, b = (neardup.Side(neardup.codes(x, np.zeros((2000, 1), np.int64)), 64, .9) for x in (u, w))
    every = a.may_link(slice(None), b, slice(None))
    assert every.diagonal().all()
    assert every.sum() - 2000 < 2e-3 * 2000**2
    estimate = (a.signs @ b.rotated.T * a.scale[:, None]).diagonal()
    assert abs(estimate.mean() - .9) < .005 and .02 < estimate.std() < .06  # unbiased; sqrt(1 - 0.81) * 0.094


def test_tables_reach_the_recall():
    for n, t in ((10, .9), (10**5, .9), (10**9, .9), (10**6, .8)):
        bits, k = neardup.tables(n, t)
        assert bits >= 8 and 1 - (1 - (1 - np.arccos(t) / np.pi) ** bits) ** k >= .995
    rng = np.random.default_rng(2)
    u = neardup.unit(rng.standard_normal((4000, 64)))
    w = np.array([near(rng, x, .9) for x in u])
    meet = (neardup.bands(u, 8, 16) == neardup.bands(w, 8, 16)).any(axis=1)
    assert meet.mean() > .99


@pytest.mark.parametrize("kind", ["float", "double"])
def test_awkward_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (None, [0.0, 1.0]), (None, [0.0, 2.0]), (12, [0.0, 1.0]), (5, [1.0, 0.001]), (13, [3.0]), (14, [-3.0]),
            (15, [2.0]), (16, [-0.0, -1.0]), (17, [0.0, -1.0]), (17, [0.0, -1.0]), (None, None), (18, [1e-30] * 2), (19, [1e30] * 2)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(
        spark.createDataFrame([(*r, 0, "v", "n", "b") for r in rows], SCHEMA.format(kind))).collect()), key=str)
    want = [(1, 2, 1, True), (2, 2, 1, False), (5, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
            (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (None, 2, 12, False), (None, 2, 12, False), (12, 2, 12, True),
            (13, 1, 13, True), (15, 1, 13, False), (14, 0, 14, True), (16, 2, 16, True), (17, 2, 16, False), (17, 2, 16, False),
            (None, 0, None, True), (18, 1, 18, True), (19, 1, 18, False)]
    assert got == sorted(want, key=str)
    empty = spark.createDataFrame([], SCHEMA.format(kind))
    assert neardup.near_duplicates(empty).count() == 0
