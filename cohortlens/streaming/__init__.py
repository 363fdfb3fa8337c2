"""Streaming use of the batch operators.

The survey pipeline has no streaming source, state or watermark.  What carries over is
that cleaning, feature building and nearest-centre scoring are row-local projections and
filters with no action inside, so they apply unchanged to a ``readStream`` DataFrame: new
responses landing in a folder can be cleaned and scored against fitted centres
incrementally, with the report tables still computed in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.clean import clean
from ..operators.cluster import assign_nearest, label_clusters
from ..operators.features import build_features, zscore
from ..spec import SURVEY, SurveySpec


def read_responses_stream(spark: SparkSession, folder: str, schema: T.StructType,
                          max_files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of raw responses in ``folder`` as a stream (explicit schema)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def features_stream(stream: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Cleaned feature rows of a response stream (stateless)."""
    return build_features(clean(stream, spec), spec)


def score_stream(features: DataFrame, centres: DataFrame, labels: DataFrame, cols: Sequence[str],
                 stats: DataFrame) -> DataFrame:
    """Archetype of each streamed row against fixed centres.

    ``stats`` is the one-row table of training means/stddevs (``__m_<c>``, ``__s_<c>``)
    so new rows are z-scored with the training scale, not their own batch's.
    """
    z = zscore(features, cols, stats=stats)
    return label_clusters(assign_nearest(z, centres, [f"z_{c}" for c in cols]), labels)
