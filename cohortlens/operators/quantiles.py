"""Grouped quantiles with linear interpolation (``percentile`` semantics).

``percentile`` keeps every distinct value of a group in one aggregation buffer, and the
final merge of a group runs in one task: fine for a 0-10 score, unbounded for a salary
over billions of rows.  ``bracketed`` selects ranks exactly with memory that does not grow:

1. one mergeable sketch per group (KLL, fixed size), written once, brackets the rank
   ``q·(n-1)`` between two values;
2. while a bracket may hold more than ``keep`` values, a pass counts what lies below, at the
   ends of and inside each bracket, sketches the inside, and so narrows the bracket some
   seventy-fold around the rank, which the counts fix exactly;
3. the last pass counts again and brings the at most ``keep`` values inside.  The two order
   statistics around ``q·(n-1)`` are read off and interpolated as ``percentile`` does.

Ties at the ends are counted, never kept, so a value that fills half a group ends up as an
end.  Groups up to some five million rows take two passes, up to 400 million three, and so
on.  A rank outside its bracket (brackets are eight standard errors of the sketch wide on each
side) stops the query rather than collect a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize

SKETCH = 4096      # KLL parameter: some 66 KB a group
KEEP = 65536       # values that a group's bracket may bring to one task
GRID = 1024        # quantiles read off a sketch


def sketch_error(size: int) -> float:
    """Rank error of a KLL sketch, as a share of the rows (2.6 standard errors)."""
    return 2.296 / size**0.9021


def grouped_quantiles(df: DataFrame, by: Sequence[str], col: str, qs: Sequence[float],
                      aliases: Sequence[str], method: str = "exact",
                      accuracy: int = 100000) -> DataFrame:
    """One row per group with a column per quantile.

    ``exact``: ``percentile`` (buffer = the group's distinct values; use for bounded
    scores).  ``bracketed``: exact, bounded memory (see module doc).  ``approx``:
    ``percentile_approx`` (rank error ≤ n/accuracy).
    """
    by = list(by)
    if method == "exact":
        aggs = [F.percentile(F.col(col), q).alias(a) for q, a in zip(qs, aliases)]
        return df.groupBy(*by).agg(*aggs)
    if method == "approx":
        aggs = [F.percentile_approx(F.col(col), q, accuracy).cast("double").alias(a)
                for q, a in zip(qs, aliases)]
        return df.groupBy(*by).agg(*aggs)
    if method == "bracketed":
        return bracketed_quantiles(df, by, col, qs, aliases)
    raise ValueError(f"unknown quantile method {method!r}")


def null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of tables with the same key columns, where null keys meet; keys come once."""
    names = {c: f"__r_{c}" for c in by}
    r = right.withColumnsRenamed(names)
    on = None
    for c, n in names.items():
        same = left[c].eqNullSafe(r[n])
        on = same if on is None else on & same
    return left.join(r, on, how).drop(*names.values())


def attach(rows: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with their group's row of ``state``.  Without keys that is one row, which is broadcast; else the
    planner broadcasts the state if it is small, and splits skewed groups if not."""
    return null_safe(rows, state, by) if by else rows.crossJoin(F.broadcast(state))


def values_of(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """``by`` and ``__x``: the non-null values as doubles; a row of a group without a value has none (null)."""
    return df.select(*by, F.col(col).cast("double").alias("__x"))


def sketches(src: DataFrame, by: Sequence[str], size: int = SKETCH) -> DataFrame:
    """Per group ``__n`` values, ``__m`` of them numbers (NaN ranks above all), and their sketch."""
    number = F.when(~F.isnan("__x"), F.col("__x"))
    return src.groupBy(*by).agg(F.count("__x").alias("__n"), F.count(number).alias("__m"),
                                F.kll_sketch_agg_double(number, F.lit(size)).alias("__sketch"))


def grid(sketch: Column, n: Column) -> Column:
    """The ``GRID + 1`` evenly spaced quantiles of a sketch (null if it is empty)."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])))


def bracket(points: Column, low: Column, high: Column, size: int, lo: Column | None = None,
            hi: Column | None = None) -> tuple[Column, Column]:
    """Values that enclose the ranks from share ``low`` to share ``high`` of a sketch's rows; ``lo`` and ``hi``
    (minus and plus infinity, unless given) where its ends are near."""
    slack = 3 * sketch_error(size)
    i, j = F.floor((low - slack) * GRID).cast("int"), F.ceil((high + slack) * GRID).cast("int")
    return (F.when(i > 0, F.get(points, i)).otherwise(F.lit(-math.inf) if lo is None else lo),
            F.when(j < GRID, F.get(points, j)).otherwise(F.lit(math.inf) if hi is None else hi))


def inside_at_most(share: Column, n: Column, size: int) -> Column:
    """A bound of the values strictly inside a bracket of the ranks within ``share`` of ``n`` rows."""
    return F.ceil((share + 8 * sketch_error(size) + 2 / GRID) * n) + 2


def counted(src: DataFrame, by: Sequence[str], state: DataFrame, targets: int, collect: bool, size: int = SKETCH) -> DataFrame:
    """One pass (a NaN is above every bracket): the state's columns and, per target i, counts below (b), at (l, h) and inside (m) its bracket
    ``__lo<i>, __hi<i>``, the nearest values outside it (u, o), and the values inside (v, sorted) or their sketch (s)."""
    keep = [c for c in state.columns if c not in by]
    x = F.col("__x")
    aggs = [F.first(c).alias(c) for c in keep]
    for i in range(targets):
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        inside = F.when((x > lo) & (x < hi), x)
        aggs += [F.count_if(x < lo).alias(f"__b{i}"), F.count_if(x == lo).alias(f"__l{i}"), F.count_if((x == hi) & (hi != lo)).alias(f"__h{i}"),
                 F.max(F.when(x < lo, x)).alias(f"__u{i}"), F.min(F.when(x > hi, x)).alias(f"__o{i}"),
                 F.count(inside).alias(f"__m{i}"),
                 F.sort_array(F.collect_list(inside)).alias(f"__v{i}") if collect
                 else F.kll_sketch_agg_double(inside, F.lit(size)).alias(f"__s{i}")]
    return attach(src, state, by).groupBy(*by).agg(*aggs)


def order_statistic(i: int, r: Column) -> Column:
    """The value of rank ``r`` (from 0) by target i's counts and values; null if it is outside its bracket."""
    b, l, h = F.col(f"__b{i}"), F.col(f"__l{i}"), F.col(f"__h{i}")
    inside = F.col(f"__v{i}")
    m = F.size(inside)
    return (F.when(r == b - 1, F.col(f"__u{i}"))
             .when(r < b, F.lit(None).cast("double"))
             .when(r < b + l, F.col(f"__lo{i}"))
             .when(r < b + l + m, F.get(inside, (r - b - l).cast("int")))
             .when(r < b + l + m + h, F.col(f"__hi{i}"))
             .when(r == b + l + m + h, F.col(f"__o{i}")))


def interpolated(i: int, q: float, n: Column, numbers: Column) -> Column:
    """The quantile of target i over ``n`` values, of which ``numbers`` are not NaN; null without a value."""
    position = F.lit(q) * (n - 1)
    low, high = F.floor(position), F.ceil(position)
    value = lambda r: F.when(r >= numbers, F.lit(math.nan)).otherwise(order_statistic(i, r))
    a, b = value(low), value(high)
    out = F.when(low == high, a).otherwise((high - position) * a + (position - low) * b)
    missed = F.raise_error(F.lit("a quantile fell outside the bracket of its sketch")).cast("double")
    return F.when(n > 0, F.coalesce(out, missed))


def measured(state: DataFrame, targets: int, name: str) -> tuple[DataFrame, int]:
    """The state written, and the largest bound of a bracket's inside (told by the same job)."""
    seen = Observation()
    out = materialize(state.observe(seen, F.max(F.greatest(*[F.col(f"__w{i}") for i in range(targets)], F.lit(0))).alias("most")), name)
    return out, int(seen.get["most"] or 0)


def bracketed_quantiles(df: DataFrame, by: Sequence[str], col: str, qs: Sequence[float],
                        aliases: Sequence[str], size: int = SKETCH, keep: int = KEEP) -> DataFrame:
    """Exact quantiles for a few large groups (see module doc); a group without a value gets nulls.  The
    sketches, and passes that narrow brackets, run now; the last pass is a lazy plan.  For many small groups,
    ``exact`` is the better choice: each group's buffer is then small."""
    by, k = list(by), len(qs)
    src = values_of(df, by, col)
    state = sketches(src, by, size).withColumn("__grid", grid(F.col("__sketch"), F.col("__m")))
    n, m = F.col("__n"), F.col("__m")
    first = {}
    for i, q in enumerate(qs):
        position = F.lit(q) * (n - 1)
        low, high = F.floor(position) / m, (F.ceil(position) + 1) / m
        lo, hi = bracket(F.col("__grid"), low, high, size)
        first |= {f"__lo{i}": F.when(m > 0, lo), f"__hi{i}": F.when(m > 0, hi),
                  f"__w{i}": F.when(m > 0, inside_at_most(high - low, m, size)).otherwise(0)}
    ends = [f"__{c}{i}" for i in range(k) for c in ("lo", "hi", "w")]
    state, most = measured(state.withColumns(first).select(*by, "__n", "__m", *ends), k, "ranks")
    while most > keep:
        state, most = measured(narrowed(counted(src, by, state, k, False, size), qs, size).select(*by, "__n", "__m", *ends), k, "ranks")
    got = counted(src, by, state, k, True)
    return got.select(*by, *[interpolated(i, q, F.col("__n"), F.col("__m")).alias(a) for i, (q, a) in enumerate(zip(qs, aliases))])


def narrowed(passed: DataFrame, qs: Sequence[float], size: int = SKETCH) -> DataFrame:
    """Brackets around the same ranks from one pass's counts and sketches of the inside."""
    new = {}
    for i, q in enumerate(qs):
        lo, hi, m = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__m{i}")
        position, below = F.lit(q) * (F.col("__n") - 1), F.col(f"__b{i}") + F.col(f"__l{i}")
        first, last = F.floor(position) - below, F.ceil(position) - below  # ranks among the values inside
        a, b = bracket(grid(F.col(f"__s{i}"), m), first / m, (last + 1) / m, size, lo, hi)
        # ranks all at or before the lower end, or all at or after the upper one: nothing inside matters
        new |= {f"__lo{i}": F.when(first >= m, hi).when((m == 0) | (last < 0), lo).otherwise(a),
                f"__hi{i}": F.when(last < 0, lo).when((m == 0) | (first >= m), hi).otherwise(b),
                f"__w{i}": F.when((m > 0) & (first < m) & (last >= 0), inside_at_most((last + 1 - first) / m, m, size)).otherwise(0)}
    return passed.withColumns(new)
