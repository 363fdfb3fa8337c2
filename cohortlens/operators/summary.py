"""Grouped summaries: counts, means, sample std, exact quantiles, indicator rates.

Every table is ONE ``groupBy().agg()``: Spark runs a map-side partial aggregate, so only
one small buffer per group and partition crosses the shuffle, whatever the group skew.
Quantiles are the exception (not algebraic); see ``quantiles.py`` for the scale-safe path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import round_half_up
from .quantiles import grouped_quantiles, null_safe


@dataclass(frozen=True)
class Measure:
    """One output column of a grouped summary.

    kind: ``count`` (non-null of col), ``rows`` (all rows), ``mean``, ``stddev`` (sample),
    ``pct`` (mean × 100, for 0/1 indicators), ``quantile`` (exact, linear interpolation).
    """

    alias: str
    kind: str
    col: str | None = None
    digits: int | None = None
    q: float | None = None


def _agg(m: Measure) -> Column:
    c = F.col(m.col) if m.col else None
    if m.kind == "rows":
        return F.count(F.lit(1))
    if m.kind == "count":
        return F.count(c)
    if m.kind == "mean":
        return F.avg(c)
    if m.kind == "stddev":
        return F.stddev_samp(c)
    if m.kind == "pct":
        return F.avg(c) * 100
    raise ValueError(f"unknown measure kind {m.kind!r}")


def summarize(df: DataFrame, by: Sequence[str] | str, measures: Sequence[Measure],
              order: Sequence[Column] | None = None, quantile_method: str = "bracketed") -> DataFrame:
    """``groupBy(by)`` + the measures, rounded HALF_UP where ``digits`` is set.

    Quantile measures are computed by ``grouped_quantiles`` and joined on the group keys
    (a join of two per-group tables: tiny, broadcast by AQE).
    """
    by = [by] if isinstance(by, str) else list(by)
    plain = [m for m in measures if m.kind != "quantile"]
    quant = [m for m in measures if m.kind == "quantile"]
    out = df.groupBy(*by).agg(*[_agg(m).alias(m.alias) for m in plain])
    if quant:
        cols = sorted({m.col for m in quant})
        for c in cols:
            ms = [m for m in quant if m.col == c]
            q = grouped_quantiles(df, by, c, [m.q for m in ms], [m.alias for m in ms], method=quantile_method)
            out = null_safe(out, q, by, "left")
    rounded = {m.alias: round_half_up(m.alias, m.digits) for m in measures if m.digits is not None}
    out = out.withColumns(rounded).select(*by, *[m.alias for m in measures])
    if order is not None:
        out = out.orderBy(*order)
    return out


def indicator_rates(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str], digits: int = 1,
                    suffix: str = "_pct", leading: Sequence[Measure] = (),
                    order: Sequence[Column] | None = None) -> DataFrame:
    """Share of rows with each 0/1 indicator set, in percent: ``round(mean(c) * 100, 1)``."""
    ms = list(leading) + [Measure(c + suffix, "pct", c, digits) for c in cols]
    return summarize(df, by, ms, order=order)


def group_means(df: DataFrame, by: Sequence[str] | str, spec: Sequence[tuple[str, str, int]],
                leading: Sequence[Measure] = (), order: Sequence[Column] | None = None) -> DataFrame:
    """Rounded means: ``spec`` is ``[(column, alias, digits), ...]``."""
    ms = list(leading) + [Measure(alias, "mean", c, d) for c, alias, d in spec]
    return summarize(df, by, ms, order=order)
