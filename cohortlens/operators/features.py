"""Feature table: item counts, multi-hot indicators, bins, and z-scored cluster inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.multivalue import count_items, multi_hot
from ..functions.recode import bucketize, first_item
from ..spec import SURVEY, UNKNOWN_ROLE, SurveySpec


def add_counts(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Product count keeps every item (an empty cell counts 1); task count drops
    the free-text "Other" answer and empty items."""
    return df.withColumns({
        "ai_product_count": count_items(spec.roles["products"], sep=spec.separator),
        "ai_task_count": count_items(spec.roles["tasks"], sep=spec.separator, drop=[spec.other_answer], drop_empty=True),
    })


def build_features(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Clean table + 2 counts + ``uses_*`` + ``lang_*`` indicators (one projection)."""
    out = add_counts(df, spec)
    out = multi_hot(out, spec.roles["products"], spec.ai_tools, "uses_", sep=spec.separator)
    return multi_hot(out, spec.roles["languages"], spec.languages, "lang_", sep=spec.separator)


def add_bins(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """``ai_usage_bin``, ``experience_bin`` and ``primary_role`` (first listed role)."""
    return df.withColumns({
        "ai_usage_bin": bucketize("ai_product_count", spec.usage_bins, closed="right"),
        "experience_bin": bucketize("years_code_pro", spec.experience_bins, closed="left"),
        "primary_role": first_item(spec.roles["dev_roles"], sep=spec.separator, default=UNKNOWN_ROLE),
    })


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features_raw") -> DataFrame:
    """``VectorAssembler`` that skips rows with a null input (as the survey pipeline does)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def scale(df: DataFrame, inp: str = "features_raw", out: str = "features"):
    """z-score a vector column with ``StandardScaler`` (mean and sample std).  Returns
    ``(scaled_df, scaler_model)``; fitting is one distributed aggregate."""
    model = StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True).fit(df)
    return model.transform(df), model


def zstats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean ``__m_<c>`` and sample deviation ``__s_<c>`` of each column."""
    return df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                  *[F.stddev_samp(c).alias(f"__s_{c}") for c in cols])


def zscore(df: DataFrame, cols: Sequence[str], prefix: str = "z_", stats: DataFrame | None = None) -> DataFrame:
    """Per-column z-scores as plain double columns.

    The row of ``zstats`` (of ``df`` itself, unless given) is joined back as a one-row
    broadcast; a constant column gives 0, like ``StandardScaler``.  No driver round trip.
    """
    stats = zstats(df, cols) if stats is None else stats
    joined = df.crossJoin(F.broadcast(stats))
    z = {f"{prefix}{c}": F.when(F.col(f"__s_{c}") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}"))) for c in cols}
    return joined.withColumns(z).drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])
