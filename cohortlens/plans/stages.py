"""Pipeline stages over the driver tables: respondents -> clean -> features -> labels.

Each stage is a lazy DataFrame built on the previous one, so a query pulls in only the
stages it needs.  ``labelled_fixed`` names archetypes from seeded centres (deterministic,
oracle-checkable); ``labelled_kmeans`` is the fitted K-Means path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cluster, lloyd
from ..operators.clean import clean
from ..session import discard, discard_since, materialize
from ..operators.features import add_bins, assemble, build_features, scale, zscore, zstats
from ..sources.respondents import respondents
from ..sources.tables import table_path
from ..spec import CLUSTER_FEATURES, RANK_FEATURE, SURVEY

Z_FEATURES = ["z_" + c for c in CLUSTER_FEATURES]
SEED_COLUMN = "ai_select_int"


_SHARED: dict = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input's files, by the file system that holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in ("orders", "customer", "nation"):
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        out += sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                      for f in path.getFileSystem(conf).listStatus(path))
    return tuple(out)


def shared(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """One materialised table per (application, input folder and files, stage).

    Many report tables scan the same stage; writing it once as Parquet in the checkpoint
    folder means the driver tables are read and joined once per stage, not once per table,
    and every later plan starts from a small file scan instead of the whole lineage.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    version = _version(spark, sf_dir)
    found = _SHARED.get(key)
    if found is None or found[0] != version:
        if found is not None:
            discard(found[1])
        _SHARED[key] = found = (version, materialize(build(), name))
    return found[1]


def release(spark: SparkSession) -> None:
    """Delete every stage that this application wrote, shared or not."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SHARED if k[0] == app]:
        del _SHARED[key]
    discard_since(spark, 0)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned respondents + counts + indicators, written once per input folder."""
    return shared(spark, sf_dir, "features",
                  lambda: build_features(clean(respondents(spark, sf_dir), SURVEY), SURVEY))


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned respondents: the feature table's leading columns (same rows)."""
    cols = clean(respondents(spark, sf_dir), SURVEY).columns
    return feature_table(spark, sf_dir).select(*cols)


def z_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with z-scores; the one row of means and deviations is a stage of its own, so
    plans that use the scores several times do not aggregate the features again."""
    stats = shared(spark, sf_dir, "zstats", lambda: zstats(feature_table(spark, sf_dir), CLUSTER_FEATURES))
    return zscore(feature_table(spark, sf_dir), CLUSTER_FEATURES, stats=stats)


def seeded_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k seeded centres, a stage of k rows."""
    return shared(spark, sf_dir, "centres",
                  lambda: cluster.seeded_centres(z_table(spark, sf_dir), SEED_COLUMN, Z_FEATURES))


def labelled_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.label_by_centres(z_table(spark, sf_dir), seeded_centres(spark, sf_dir), Z_FEATURES,
                                    "z_" + RANK_FEATURE)


def binned_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "binned", lambda: add_bins(labelled_fixed(spark, sf_dir)))


def vector_features(features: DataFrame, columns=tuple(CLUSTER_FEATURES)):
    """Assemble and z-score the clustering inputs: ``features_raw`` and ``features``."""
    return scale(assemble(features, columns))


def labelled_kmeans(features: DataFrame, k: int = 3, seed: int = 42, max_iter: int = 40, key: str = "ResponseId",
                    columns=tuple(CLUSTER_FEATURES), rank_feature: str = RANK_FEATURE, go_on=None):
    """Fit K-Means on the features, from starts chosen by hashes of ``key``, and name the clusters.

    The fit runs now, on any layout with the same result; returns ``(labelled_df, model, centroids_df, labels_df)``
    with the labelled rows as a lazy projection of ``features``."""
    model = lloyd.fit(features, [k], columns, key, max_iter, seed, go_on)[k]
    centroids = lloyd.centroid_table(features.sparkSession, model)
    labels = cluster.label_table(centroids, rank_feature)
    return cluster.label_clusters(lloyd.assign(features, model), labels), model, centroids, labels


def checkpointed(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a Parquet table in the session's shared folder (``session.shared_folder``)."""
    return materialize(df, name)
