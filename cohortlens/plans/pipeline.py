"""End to end: survey rows -> cleaned features -> K-Means archetypes -> report tables.

Materialisation points, each chosen for a reason:

* the feature table is written to ``spark.checkpoint.dir``: the fits read its feature columns
  once per step, and a lost executor re-reads files instead of re-running scan and cleaning;
  partitions follow the files, and the fits do not depend on them;
* the labelled table is written once (Parquet, same folder) for the report tables, so
  each report scan reads only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import lloyd
from ..operators.clean import clean, clean_funnel
from ..operators.features import add_bins, build_features
from ..operators.figures import centroid_heatmap
from ..session import MADE, discard, discard_since
from ..sources.sinks import write_tables
from ..spec import SURVEY, SurveySpec
from . import report
from .stages import checkpointed, labelled_kmeans


class Tables(dict):
    """Result tables by name.  They read files that the run wrote; ``release`` deletes those, once the
    tables are written or collected (what is left goes when the application ends)."""

    def __init__(self, spark: SparkSession, mark: int):
        super().__init__()
        self.spark, self.mark = spark, mark

    def release(self) -> None:
        discard_since(self.spark, self.mark)


def run(source: DataFrame, spec: SurveySpec = SURVEY, k: int = 3, ks: Sequence[int] | None = range(2, 9),
        out_dir: str | None = None, fmt: str = "parquet", quantile_method: str = "bracketed",
        seed: int = 42, key: str | None = None) -> Tables:
    """Run the whole analysis over ``source`` (raw survey rows).

    Returns every result table by name; with ``out_dir`` they are also written and published as one
    catalogue (``sinks``), the labelled per-respondent table with them.
    """
    spark = source.sparkSession
    tables = Tables(spark, len(MADE))
    tables["clean_funnel"] = clean_funnel(source, spec)
    feats = checkpointed(build_features(clean(source, spec), spec), "features")
    key, columns = key or spec.id_col, spec.cluster_features
    models = lloyd.fit(feats, ks, columns, key, max_iter=20, seed=seed) if ks else {}
    if ks:
        tables["k_sweep"] = checkpointed(lloyd.sweep_table(feats, models), "sweep")
    named, model, centroids, labels = labelled_kmeans(feats, k, seed, 40, key, columns, spec.rank_feature,
                                                      {k: models[k]} if k in models else None)
    tables["final_model"] = checkpointed(lloyd.score(feats, {k: model}), "score")
    labelled = checkpointed(add_bins(named, spec), "labelled")
    tables["centroids"] = centroid_heatmap(centroids, labels, features=spec.cluster_features)
    tables.update(report.impact_report(labelled, quantile_method, spec))
    tables.update(report.deep_dive(labelled, quantile_method, spec))
    tables["labelled"] = labelled
    if out_dir is not None:
        named = {n: t for n, t in tables.items() if n != "labelled"}
        write_tables(named, out_dir, fmt=fmt, single_file=True, labelled=labelled)
    discard(feats)
    return tables
