"""Top-N values per group.

Counts are pre-aggregated per (group, value) before anything is ranked, so the window only
ever sees one row per distinct pair; ``row_number() <= n`` is planned as a
``WindowGroupLimit`` that keeps n rows per group before the final sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.multivalue import clean_items


def topn_per_group(df: DataFrame, group: str, col: str, n: int, out: str | None = None,
                   count_col: str = "count", weight: str | None = None) -> DataFrame:
    """``(group, value, count)`` for the n most frequent non-null values in each group.

    Ties: value ascending.  ``count`` is a bigint: one key may hold a third of billions of
    rows.  ``weight`` names a column of pre-aggregated row counts to sum instead.
    """
    out = out or col
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(group, col).agg(amount.cast("long").alias(count_col)))
    w = Window.partitionBy(group).orderBy(F.desc(count_col), F.asc(col))
    ranked = counts.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return ranked.select(group, F.col(col).alias(out), count_col).orderBy(group, F.desc(count_col), out)


def topn_items_per_group(df: DataFrame, group: str, col: str, n: int, out: str,
                         sep: str = ";", count_col: str = "count") -> DataFrame:
    """Same, over the trimmed non-empty items of a multi-value column."""
    items = df.where(F.col(col).isNotNull()).select(group, F.explode(clean_items(col, sep)).alias(out))
    return topn_per_group(items, group, out, n, count_col=count_col)
