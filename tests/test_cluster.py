"""Clustering: closed forms against brute force, labels, K-Means invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cluster, lloyd
from cohortlens.plans import stages
from cohortlens.spec import CLUSTER_FEATURES

COLS = ["a", "b", "c"]


def _points(spark, n=150, seed=3, k=3, spread=4.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = i % k
        rows.append((i, g, *[rnd.gauss(spread * g + j, 1.0) for j in range(len(COLS))]))
    return spark.createDataFrame(rows, "id long, g int, a double, b double, c double"), rows


def _silhouette_brute(rows, k):
    pts = np.array([r[2:] for r in rows])
    lab = np.array([r[1] for r in rows])
    s = []
    for i in range(len(pts)):
        d = ((pts - pts[i]) ** 2).sum(axis=1)
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[lab == c].mean() for c in range(k) if c != lab[i] and (lab == c).any())
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_closed_form_equals_definition(spark):
    df, rows = _points(spark)
    got = cluster.silhouette(df, COLS, pred="g").collect()[0][0]
    assert math.isclose(got, _silhouette_brute(rows, 3), rel_tol=1e-9)


def test_silhouette_equals_clustering_evaluator(spark):
    from pyspark.ml.feature import VectorAssembler
    df, _ = _points(spark)
    vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(df)
    ev = cluster.evaluate_silhouette(vec, "features", "g")
    got = cluster.silhouette(df, COLS, pred="g").collect()[0][0]
    assert math.isclose(got, ev, rel_tol=1e-9)


def test_assign_and_wssse_against_numpy(spark):
    df, rows = _points(spark)
    centres = spark.createDataFrame([(0, 0.0, 1.0, 2.0), (1, 4.0, 5.0, 6.0), (2, 4.0, 5.0, 6.0)],
                                    "cluster int, a double, b double, c double")
    got = {r.id: r.prediction for r in cluster.assign_nearest(df, centres, COLS).collect()}
    c = np.array([[0, 1, 2], [4, 5, 6], [4, 5, 6]], dtype=float)
    total = 0.0
    for r in rows:
        d = ((c - np.array(r[2:])) ** 2).sum(axis=1)
        assert got[r[0]] == int(np.argmin(d))  # equal centres 1 and 2: the lower id wins
        total += d.min()
    w = cluster.wssse(df, centres, COLS).collect()[0]
    assert math.isclose(w.wssse, total, rel_tol=1e-12) and w.n == len(rows)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_archetype_labels(spark, n):
    centres = spark.createDataFrame([(i, float(n - i)) for i in range(n)], "cluster int, p double")
    labels = {r.prediction: r.archetype for r in cluster.label_table(centres, "p").collect()}
    by_rank = [labels[n - 1 - r] for r in range(n)]  # cluster n-1 has the smallest coordinate
    assert by_rank[0] == "Traditional Engineer" and by_rank[-1] == "AI Power User"
    if n == 3:
        assert by_rank[1] == "AI Experimenter"
    if n >= 4:
        assert by_rank[1] == "Light AI User"
        assert by_rank[2:-1] == [f"AI Experimenter (tier {r})" for r in range(2, n - 1)]


def test_label_fallback(spark):
    df = spark.createDataFrame([(0,), (7,)], "prediction int")
    labels = spark.createDataFrame([(0, 0, "Traditional Engineer")], "prediction int, rank int, archetype string")
    got = {r.prediction: r.archetype for r in cluster.label_clusters(df, labels).collect()}
    assert got == {0: "Traditional Engineer", 7: "Cluster 7"}


def test_delta_cost_lag(spark):
    t = spark.createDataFrame([(3, 80.0, 0.4), (2, 100.0, 0.5), (4, 75.0, 0.3)], "k int, wssse double, silhouette double")
    got = {r.k: r.delta_cost for r in cluster.with_delta_cost(t).collect()}
    assert got == {2: 0.0, 3: 20.0, 4: 5.0}


def test_kmeans_recovers_planted_clusters_and_is_repeatable(spark):
    df, rows = _points(spark, n=300, spread=12.0)
    from pyspark.ml.feature import VectorAssembler
    vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(df).repartition(4, "id").persist()
    m1 = cluster.fit_kmeans(vec, 3, max_iter=20)
    m2 = cluster.fit_kmeans(vec, 3, max_iter=20)
    assert np.allclose(np.array(m1.clusterCenters()), np.array(m2.clusterCenters()))
    pred = m1.transform(vec).groupBy("g", "prediction").count().collect()
    assert len(pred) == 3  # each planted group maps to exactly one cluster


def test_kmeans_pipeline_invariants(spark, sf_dir):
    feats = stages.feature_table(spark, sf_dir)
    models = lloyd.fit(feats, range(2, 6), CLUSTER_FEATURES, "ResponseId", max_iter=20)
    sweep = lloyd.sweep_table(feats, models).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4, 5]
    for a, b in zip(sweep, sweep[1:]):
        assert b.wssse <= a.wssse * 1.02
        assert math.isclose(b.delta_cost, a.wssse - b.wssse, rel_tol=1e-12)
    assert all(-1.0 <= r.silhouette <= 1.0 for r in sweep)
    labelled, model, centroids, labels = stages.labelled_kmeans(feats, k=3)
    assert model.steps <= 40 and sum(model.nearest.n) == feats.count()
    sizes = labelled.groupBy("archetype").count().collect()
    assert {r.archetype for r in sizes} == {"Traditional Engineer", "AI Experimenter", "AI Power User"}
    assert sorted(r["count"] for r in sizes) == sorted(model.nearest.n)
    ranks = {r.archetype: r.rank for r in labels.collect()}
    cent = {r.cluster: r.ai_product_count for r in centroids.collect()}
    lab_to_cluster = {r.archetype: r.prediction for r in labels.collect()}
    assert cent[lab_to_cluster["Traditional Engineer"]] <= cent[lab_to_cluster["AI Power User"]]
    assert ranks["Traditional Engineer"] == 0 and ranks["AI Power User"] == 2


def test_sweep_scores_equal_the_library(spark):
    """Scores of all k from one scan against the evaluator and brute-force cost; doubles, a null and a constant column."""
    from pyspark.ml.feature import VectorAssembler

    df, rows = _points(spark, n=400, spread=3.0)
    df = df.withColumn("same", F.lit(7.0)).unionByName(spark.createDataFrame([(999, 0, None, 1.0, 2.0, 7.0)], "id long, g int, a double, b double, c double, same double"))
    cols = [*COLS, "same"]
    models = lloyd.fit(df, [1, 2, 3, 5], cols, "id", max_iter=30)
    got = {r.k: r for r in lloyd.score(df, models).collect()}
    pts = np.array([r[2:] for r in rows])
    z = (pts - pts.mean(axis=0)) / pts.std(axis=0, ddof=1)
    assert np.allclose(models[3].mean[:3], pts.mean(axis=0)) and models[3].deviation[3] == 0
    for k, m in models.items():
        c = np.array(m.scaled())[:, :3]
        d = ((z[:, None] - c[None]) ** 2).sum(axis=2)
        assert math.isclose(got[k].wssse, d.min(axis=1).sum(), rel_tol=1e-9)
        if k == 1:
            assert got[k].silhouette == 0
            continue
        assert all(np.allclose(c[j], z[d.argmin(axis=1) == j].mean(axis=0)) for j in range(k))  # the fit stands still
        named = lloyd.assign(df, m)
        assert named.count() == 400 and [r.prediction for r in named.orderBy("id").collect()] == d.argmin(axis=1).tolist()
        flat = spark.createDataFrame([(int(j), *map(float, x)) for j, x in zip(d.argmin(axis=1), z)], "prediction int, a double, b double, c double")
        vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(flat)
        assert math.isclose(got[k].silhouette, cluster.evaluate_silhouette(vec), rel_tol=1e-9)


def test_planted_clusters_starts_and_continued_fits(spark):
    df, rows = _points(spark, n=300, spread=12.0)
    starts = lloyd.start_points(df, COLS, "id", 3)
    order = sorted(rows, key=lambda r: __import__("hashlib").sha256(f"42:{r[0]}".encode()).hexdigest())
    assert starts == [list(r[2:]) for r in order[:3]]
    m = lloyd.fit(df, [3], COLS, "id")[3]
    part = lloyd.fit(df, [3], COLS, "id", max_iter=1)
    assert part[3].steps == 1 and lloyd.fit(df, [3], COLS, "id", go_on=part)[3] == m  # the rest of the same steps
    twice = spark.createDataFrame([(i, float(i % 2)) for i in range(500)], "id long, a double")
    assert lloyd.start_points(twice, ["a"], "id", 5) in ([[0.0], [1.0]], [[1.0], [0.0]])  # no more than the different points
    two = lloyd.fit(twice, [5], ["a"], "id")[5]
    assert len(two.centres) == 2 and sorted(two.nearest.n) == [250, 250]
    with pytest.raises(ValueError):
        lloyd.fit(twice.where("id < 0"), [2], ["a"], "id")


def test_stable_layout_makes_fits_repeatable_across_layouts(spark):
    from pyspark.ml.feature import VectorAssembler
    df, _ = _points(spark, n=600, spread=3.0)
    models = []
    for parts in (1, 3, 7):
        shuffled = df.repartition(parts)
        vec = VectorAssembler(inputCols=COLS, outputCol="features").transform(
            cluster.stable_layout(shuffled, "id", partitions=4))
        models.append(np.array(sorted(map(tuple, cluster.fit_kmeans(vec, 3, max_iter=20).clusterCenters()))))
    assert np.allclose(models[0], models[1]) and np.allclose(models[0], models[2])


def test_assign_skips_rows_with_missing_features(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, None, 1.0, 1.0)], "id long, a double, b double, c double")
    centres = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 9.0, 9.0, 9.0)], "cluster int, a double, b double, c double")
    got = {r.id: r.prediction for r in cluster.assign_nearest(df, centres, COLS).collect()}
    assert got == {1: 0, 2: None}


SF01 = "/root/testdata/sf0.01"


def test_kmeans_is_the_same_on_any_layout(spark):
    """Not to a tolerance: the same centres, to the last bit, for 1, 4, 32 and 200 partitions."""
    import os

    if not os.path.isdir(SF01):
        pytest.skip("driver test data not present")
    feats = stages.feature_table(spark, SF01).select("ResponseId", *CLUSTER_FEATURES).persist()
    seen = [lloyd.fit(feats.repartition(n), [3, 5], CLUSTER_FEATURES, "ResponseId", max_iter=12) for n in (1, 4, 32, 200)]
    assert all(m == seen[0] for m in seen[1:])
    feats.unpersist()


def test_standard_scaler_equals_zscore(spark, sf_dir):
    from cohortlens.plans import stages
    from cohortlens.spec import CLUSTER_FEATURES

    scaled, _ = stages.vector_features(stages.feature_table(spark, sf_dir))
    z = {r.ResponseId: [r[c] for c in stages.Z_FEATURES] for r in stages.z_table(spark, sf_dir).collect()}
    for r in scaled.select("ResponseId", "features").collect():
        assert max(abs(a - b) for a, b in zip(r.features, z[r.ResponseId])) < 1e-9
    assert len(CLUSTER_FEATURES) == len(stages.Z_FEATURES)
