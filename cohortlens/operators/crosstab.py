"""Category mixes, global top-k values, semi-join filters and two-way pivots.

A share table is a single conditional aggregate (``count_if`` per category next to the
total), not a pivot joined back to a totals table: one scan, one shuffle of tiny partial
buffers.  Top-k value lists stay DataFrames and filter by broadcast left-semi join (the
list is at most k rows, so its size is bounded by construction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import round_half_up, unique_names
from .quantiles import null_safe


def share_pivot(df: DataFrame, by: str, col: str, values: Sequence[str],
                aliases: Sequence[str] | None = None, denom: str = "non_null",
                digits: int = 1, require_match: bool = False) -> DataFrame:
    """Percent of each group's rows in each listed category of ``col``.

    ``denom="non_null"``: rows with ``col`` null are left out entirely (values outside the
    list still count in ``total``).  ``denom="all"``: ``total`` is every row of the group.
    ``require_match`` keeps only groups with at least one listed value (the effect of an
    inner join of pivoted counts to totals).  Missing cells are 0.
    """
    aliases = unique_names(list(aliases) if aliases is not None else [v + "_pct" for v in values])
    src = df.where(F.col(col).isNotNull()) if denom == "non_null" else df
    hits = [F.count_if(F.col(col) == F.lit(v)).alias(f"__n{i}") for i, v in enumerate(values)]
    out = src.groupBy(by).agg(F.count(F.lit(1)).alias("total"), *hits)
    if require_match:
        any_hit = None
        for i in range(len(values)):
            any_hit = F.col(f"__n{i}") > 0 if any_hit is None else any_hit | (F.col(f"__n{i}") > 0)
        out = out.where(any_hit)
    pct = [round_half_up(F.col(f"__n{i}") * 100.0 / F.col("total"), digits).alias(a)
           for i, a in enumerate(aliases)]
    return out.select(by, "total", *pct).orderBy(by)


def topk(df: DataFrame, col: str, k: int, exclude: Sequence[str] = (), count_col: str = "count") -> DataFrame:
    """The k most frequent non-null values of ``col`` (ties: value ascending).

    Partial counts per value, then ``TakeOrderedAndProject``: only k rows per partition
    reach the final task.
    """
    src = df.where(F.col(col).isNotNull())
    if exclude:
        src = src.where(~F.col(col).isin(list(exclude)))
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.desc(count_col), F.asc(col)).limit(k)


def filter_topk(df: DataFrame, col: str, top: DataFrame) -> DataFrame:
    """Rows whose ``col`` is among ``top[col]``: broadcast left-semi join (top is k rows)."""
    return df.join(F.broadcast(top.select(col)), on=col, how="left_semi")


def share_long(df: DataFrame, by: str, col: str, top: DataFrame, digits: int = 1) -> DataFrame:
    """Long form of a data-dependent mix: ``(by, col, n, total, pct)`` with a fixed schema.

    ``total`` counts every row of the group; groups or cells without a listed value are
    absent (as the wide table drops groups with no listed value).
    """
    totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("total"))
    cells = filter_topk(df, col, top).groupBy(by, col).agg(F.count(F.lit(1)).alias("n"))
    out = null_safe(cells, totals, [by])
    return out.select(by, col, "n", "total",
                      round_half_up(F.col("n") * 100.0 / F.col("total"), digits).alias("pct")) \
              .orderBy(by, col)


def share_wide(long: DataFrame, by: str, col: str, values: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Wide form of ``share_long`` with one column per value (missing cell -> 0)."""
    names = unique_names(list(names))
    pivoted = long.groupBy(by, "total").pivot(col, list(values)).agg(F.first("pct"))
    return pivoted.select(by, "total", *[F.coalesce(F.col(f"`{v}`"), F.lit(0.0)).alias(n)
                                         for v, n in zip(values, names)]).orderBy(by)


def pivot_mean(df: DataFrame, row: str, col: str, values: Sequence[str], measure: str,
               digits: int | None = 0, order: Sequence[Column] | None = None) -> DataFrame:
    """Two-way table of ``round(mean(measure))``; empty cells are null.

    ``pivot`` with an explicit value list: no discovery job, one aggregate.
    """
    agg = F.avg(measure)
    if digits is not None:
        agg = round_half_up(agg, digits)
    out = df.groupBy(row).pivot(col, list(values)).agg(agg)
    return out.orderBy(*(order if order is not None else [F.asc(row)]))


def pivot_count(df: DataFrame, row: str, col: str, values: Sequence[str],
                order: Sequence[Column] | None = None) -> DataFrame:
    """Two-way cell counts; an empty cell is null (not 0), as ``pivot().count()`` gives."""
    out = df.groupBy(row).pivot(col, list(values)).count()
    return out.orderBy(*(order if order is not None else [F.asc(row)]))


def ordered_by(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Rows in a fixed category order; values outside ``order`` go last, by value."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))
    return df.orderBy(F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos), F.col(col))
