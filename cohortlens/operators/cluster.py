"""Clustering: nearest-centre assignment, WSSSE, silhouette, labels, and the library's K-Means fit
(``lloyd`` has the fits of the report).

Centres are k rows, so they travel as ONE packed row (``array<struct>``) broadcast to every
task; distances, the arg-min, the WSSSE and the silhouette are then column arithmetic over
that array (``transform`` / ``array_min`` / ``aggregate``): narrow, codegen'd, no per-row
Python and no n×k intermediate rows.  Only per-cluster sums (k rows) are aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import (ARCHETYPE_FALLBACK, ARCHETYPE_FIRST, ARCHETYPE_LAST, ARCHETYPE_MIDDLE_OF_THREE,
                    ARCHETYPE_SECOND, ARCHETYPE_TIER)


def _sq_dist(cols: Sequence[str], c: Column) -> Column:
    """Squared Euclidean distance of the row's ``cols`` to packed centre ``c`` (fields x0..)."""
    terms = [(F.col(x) - c[f"x{i}"]) * (F.col(x) - c[f"x{i}"]) for i, x in enumerate(cols)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def pack_centres(centres: DataFrame, cols: Sequence[str], cid: str = "cluster") -> DataFrame:
    """k centre rows -> one row ``__centres: array<struct<cid, x0, ...>>`` (size k)."""
    fields = [F.col(cid).cast("int").alias("cid")] + [F.col(c).cast("double").alias(f"x{i}")
                                                      for i, c in enumerate(cols)]
    return centres.agg(F.collect_list(F.struct(*fields)).alias("__centres"))


def assign_nearest(df: DataFrame, centres: DataFrame, cols: Sequence[str], cid: str = "cluster",
                   out: str = "prediction", dist_col: str | None = None) -> DataFrame:
    """Nearest centre by squared Euclidean distance (ties: lower centre id).

    ``centres`` has one row per centre with ``cid`` and the same ``cols`` as ``df``.
    """
    packed = pack_centres(centres, cols, cid)
    joined = df.crossJoin(F.broadcast(packed))
    dists = F.transform("__centres", lambda c: F.struct(_sq_dist(cols, c).alias("d"), c["cid"].alias("cid")))
    complete = None
    for c in cols:
        complete = F.col(c).isNotNull() if complete is None else complete & F.col(c).isNotNull()
    best = F.when(complete, F.array_min(dists))  # a row with a missing feature gets no centre
    res = joined.withColumn("__best", best).withColumn(out, F.col("__best.cid"))
    if dist_col:
        res = res.withColumn(dist_col, F.col("__best.d"))
    return res.drop("__centres", "__best")


def wssse(df: DataFrame, centres: DataFrame, cols: Sequence[str], cid: str = "cluster") -> DataFrame:
    """Within-set sum of squared errors of ``df`` against fixed centres (one row)."""
    a = assign_nearest(df, centres, cols, cid, out="__p", dist_col="__d")
    return a.agg(F.sum("__d").alias("wssse"), F.count(F.lit(1)).alias("n"))


def seeded_centres(df: DataFrame, seed_col: str, cols: Sequence[str], cid: str = "cluster") -> DataFrame:
    """Centres = feature means of the groups of a seeding column (one Lloyd step from a
    rule-based partition).  Deterministic, so results can be checked exactly."""
    means = df.groupBy(seed_col).agg(*[F.avg(c).alias(c) for c in cols])
    w = Window.orderBy(seed_col)
    return means.withColumn(cid, (F.dense_rank().over(w) - 1).cast("int")).select(cid, *cols)


def cluster_stats(df: DataFrame, cols: Sequence[str], pred: str = "prediction") -> DataFrame:
    """Per-cluster count, coordinate sums and sum of squared norms (k rows)."""
    sq = None
    for c in cols:
        t = F.col(c) * F.col(c)
        sq = t if sq is None else sq + t
    return df.groupBy(pred).agg(F.count(F.lit(1)).alias("n"),
                                *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
                                F.sum(sq).alias("psi"))


def silhouette(df: DataFrame, cols: Sequence[str], pred: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, in closed form (one row).

    For a point x and cluster C: d(x, C) = |x|² - 2 x·ΣC/n_C + Ψ_C/n_C.  Own-cluster
    dissimilarity is scaled by n/(n-1) (self excluded); a singleton scores 0.  This is the
    same O(n·k·d) computation as ``ClusteringEvaluator``, written as DataFrame columns.
    """
    stats = cluster_stats(df, cols, pred)
    packed = stats.agg(F.collect_list(F.struct(
        F.col(pred).cast("int").alias("cid"), F.col("n").cast("double").alias("n"),
        *[F.col(f"s{i}").alias(f"s{i}") for i in range(len(cols))], F.col("psi"))).alias("__cs"))
    sq = None
    for c in cols:
        t = F.col(c) * F.col(c)
        sq = t if sq is None else sq + t

    def dissim(cs):
        dot = None
        for i, c in enumerate(cols):
            t = F.col(c) * cs[f"s{i}"]
            dot = t if dot is None else dot + t
        return F.col("__sq") + cs["psi"] / cs["n"] - 2 * dot / cs["n"]

    j = df.select(F.col(pred).cast("int").alias("__p"), *cols).crossJoin(F.broadcast(packed)) \
          .withColumn("__sq", sq)
    own = F.filter("__cs", lambda cs: cs["cid"] == F.col("__p"))[0]
    others = F.transform(F.filter("__cs", lambda cs: cs["cid"] != F.col("__p")), dissim)
    j = j.withColumn("__own_n", own["n"]).withColumn("__a", F.try_divide(dissim(own) * own["n"], own["n"] - 1)) \
         .withColumn("__b", F.array_min(others))
    s = (F.when(F.col("__own_n") <= 1, F.lit(0.0))
          .when(F.col("__a") < F.col("__b"), 1 - F.col("__a") / F.col("__b"))
          .when(F.col("__a") > F.col("__b"), F.col("__b") / F.col("__a") - 1)
          .otherwise(F.lit(0.0)))
    return j.agg(F.avg(s).alias("silhouette"))


# ---------------------------------------------------------------------------
# K-Means with pyspark.ml
# ---------------------------------------------------------------------------

LAYOUT_PARTITIONS = 32


def stable_layout(df: DataFrame, key: str, partitions: int = LAYOUT_PARTITIONS) -> DataFrame:
    """Hash-partition by ``key`` into an explicit number of partitions, sorted within each: the
    same rows always land in the same partitions in the same order, whatever layout they
    arrived in and however many cores there are.  K-Means initialisation samples per
    partition, so a seeded fit repeats.  Raise ``partitions`` with the data volume (about one
    per 128 MB); the number is part of what fixes the result."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit_kmeans(df: DataFrame, k: int, seed: int = 42, max_iter: int = 40,
               features_col: str = "features", prediction_col: str = "prediction") -> KMeansModel:
    """``KMeans`` fit.  Results depend on the input's partition layout, even with a fixed
    seed: use ``stable_layout`` for repeatability, and compare labels, not raw ids."""
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features_col, predictionCol=prediction_col)
    return km.fit(df)


def evaluate_silhouette(predictions: DataFrame, features_col: str = "features",
                        prediction_col: str = "prediction") -> float:
    return ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                               metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(predictions)


def with_delta_cost(t: DataFrame, k: str = "k", cost: str = "wssse") -> DataFrame:
    """``delta_cost = lag(cost) - cost`` ordered by k; 0 for the first row."""
    w = Window.orderBy(k)
    return t.withColumn("delta_cost", F.coalesce(F.lag(cost).over(w) - F.col(cost), F.lit(0.0)))


def centroid_table(spark: SparkSession, model: KMeansModel, names: Sequence[str],
                   cid: str = "cluster") -> DataFrame:
    """Model centres as a DataFrame: ``(cluster, <feature>...)`` (k rows)."""
    schema = T.StructType([T.StructField(cid, T.IntegerType())] +
                          [T.StructField(n, T.DoubleType()) for n in names])
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, schema)


def archetype_label(rank: Column, n: Column) -> Column:
    """Name of the cluster at ``rank`` (0 = fewest AI products) among ``n`` clusters."""
    return (F.when(rank == 0, F.lit(ARCHETYPE_FIRST))
             .when(rank == n - 1, F.lit(ARCHETYPE_LAST))
             .when((n == 3) & (rank == 1), F.lit(ARCHETYPE_MIDDLE_OF_THREE))
             .when(rank == 1, F.lit(ARCHETYPE_SECOND))
             .otherwise(F.format_string(ARCHETYPE_TIER.replace("{rank}", "%d"), rank)))


def label_table(centres: DataFrame, rank_col: str, cid: str = "cluster",
                out: str = "prediction") -> DataFrame:
    """``(prediction, rank, archetype)``: centres ranked by one coordinate (ties: id)."""
    w = Window.orderBy(F.col(rank_col), F.col(out))
    ranked = centres.select(F.col(cid).cast("int").alias(out), rank_col) \
        .withColumn("rank", (F.row_number().over(w) - 1).cast("int")) \
        .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy()))
    return ranked.select(out, "rank", archetype_label(F.col("rank"), F.col("__n")).alias("archetype"))


def label_clusters(df: DataFrame, labels: DataFrame, pred: str = "prediction") -> DataFrame:
    """Attach ``archetype`` by broadcast join on the cluster id (labels: k rows); an id
    without a label falls back to ``Cluster <id>``."""
    lab = labels.select(F.col(pred), F.col("archetype").alias("__label"))
    fallback = F.concat(F.lit(ARCHETYPE_FALLBACK.replace("{id}", "")), F.col(pred).cast("string"))
    return df.join(F.broadcast(lab), on=pred, how="left") \
             .withColumn("archetype", F.coalesce(F.col("__label"), fallback)).drop("__label")


def fixed_archetypes(df: DataFrame, cols: Sequence[str], seed_col: str, rank_col: str) -> DataFrame:
    """Archetypes from seeded centres: z-scored ``cols`` (as ``z_*``) must be present.

    centres = group means under ``seed_col``; rows go to the nearest centre; centres are
    named by their ``rank_col`` coordinate.  Deterministic, so it is oracle-checkable.
    """
    return label_by_centres(df, seeded_centres(df, seed_col, cols), cols, rank_col)


def label_by_centres(df: DataFrame, centres: DataFrame, cols: Sequence[str], rank_col: str) -> DataFrame:
    """Nearest of ``centres`` (k rows) and its name, in one pass over ``df``."""
    return label_clusters(assign_nearest(df, centres, cols), label_table(centres, rank_col))
