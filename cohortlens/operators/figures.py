"""The tables behind the report figures (drawing itself is left to the caller).

Each figure's data is a DataFrame with explicit display positions, so order survives any
later shuffle or write.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.recode import round_half_up
from ..session import materialize
from ..spec import ARCHETYPE_ORDER, CLUSTER_FEATURES, COUNTRY_SHORT_NAMES, USAGE_BINS
from .quantiles import (GRID, KEEP, SKETCH, bracket, counted, grid, grouped_quantiles, inside_at_most, interpolated, measured, null_safe,
                        sketch_error, sketches, values_of)

# FIXED VALUES: display names of the centroid heatmap columns and the country order.
CENTROID_DISPLAY = ["ai_select", "ai_products", "ai_tasks", "ai_trust", "ai_threat",
                    "ai_sentiment", "ai_benefits", "years_exp", "org_size"]
COUNTRY_DISPLAY_ORDER = ["USA", "UK", "Germany", "Ukraine", "India"]
NO_USAGE = USAGE_BINS[0][0]


def position_in(c, order: Sequence[str]) -> Column:
    """1-based position of ``c`` in ``order``; null when absent."""
    c = F.col(c) if isinstance(c, str) else c
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), c).cast("int")
    return F.when(pos > 0, pos)


def in_display_order(df: DataFrame, col: str, order: Sequence[str] = ARCHETYPE_ORDER) -> DataFrame:
    return df.withColumn("position", position_in(col, order)).orderBy(F.asc_nulls_last("position"), col)


def trim_upper(df: DataFrame, col: str, q: float, method: str = "bracketed") -> DataFrame:
    """Rows with ``col <= quantile(col, q)`` (global, linear interpolation).  The cut is a
    one-row aggregate joined back as a broadcast."""
    cut = grouped_quantiles(df, [], col, [q], ["__cut"], method=method)
    return df.crossJoin(F.broadcast(cut)).where(F.col(col) <= F.col("__cut")).drop("__cut")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(df: DataFrame, by: str, col: str, trim_q: float | None = 0.99, digits: int = 2,
              method: str = "bracketed") -> DataFrame:
    """Quartiles and 1.5·IQR whiskers per group (whisker = last point inside the fence),
    after an optional global upper trim.

    ``bracketed``: three passes over the rows.  One sketch per group is written once; merged over the groups
    it brackets the cut, alone it brackets each group's quartiles, whatever the cut turns out to be within its
    bracket.  The second pass counts for all brackets, the third finds the whiskers.  Groups too large for that
    (see ``quantiles``) are cut first and then narrowed on their own."""
    src = df.where(F.col(col).isNotNull()).select(by, col)
    told = _box_counts(src, by, col, trim_q) if method == "bracketed" and trim_q is not None else None
    if told is None:
        if trim_q is not None:
            src = trim_upper(src, col, trim_q, method)
        box = grouped_quantiles(src, [by], col, list(QUARTILES.values()), list(QUARTILES), method=method).withColumn("__cut", F.lit(math.inf))
    else:
        box = told
    j = null_safe(src, box, [by]).where(F.col(col) <= F.col("__cut"))  # one row per group: broadcast if it turns out small
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    out = j.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in QUARTILES],
        F.min(F.when(F.col(col) >= lo_fence, F.col(col))).alias("whisker_low"),
        F.max(F.when(F.col(col) <= hi_fence, F.col(col))).alias("whisker_high"))
    return out.select(by, "n", *[round_half_up(c, digits).alias(c)
                                 for c in (*QUARTILES, "whisker_low", "whisker_high")]) \
              .withColumn("position", position_in(by, ARCHETYPE_ORDER)).orderBy(by)


def _box_counts(src: DataFrame, by: str, col: str, trim_q: float) -> DataFrame | None:
    """Per group its quartiles under the cut, and the cut; None if a bracket may hold too many values."""
    x = values_of(src, [by], col)
    seen = Observation()
    groups = materialize(sketches(x, [by]).where("__m > 0").observe(seen, F.sum("__n").alias("n"), F.sum("__m").alias("m")), "sketches")
    total, numbers = (seen.get["n"] or 0), (seen.get["m"] or 0)
    if total == 0 or total > numbers:  # a NaN: the plain way ranks it
        return None
    rank = trim_q * (total - 1)
    cut_points = grid(F.col("__all"), F.lit(numbers))
    lo, hi = bracket(cut_points, F.lit(math.floor(rank) / total), F.lit((math.ceil(rank) + 1) / total), SKETCH)
    cut = groups.agg(F.kll_merge_agg_double("__sketch").alias("__all")).select(lo.alias("__lo0"), hi.alias("__hi0"))
    # the share of a group below either end of the cut's bracket, by the group's own sketch
    points, slack = F.col("__grid"), 1 / GRID + 3 * sketch_error(SKETCH)
    below = lambda c: F.size(F.filter(points, lambda p: p <= F.col(c))) / (GRID + 1)
    state = groups.crossJoin(F.broadcast(cut)).withColumn("__grid", grid(F.col("__sketch"), F.col("__m"))) \
        .withColumns({"__least": F.greatest(below("__lo0") - slack, F.lit(0.0)), "__most": F.least(below("__hi0") + slack, F.lit(1.0))})
    ends = {"__w0": inside_at_most(F.lit(2.0 / total), F.lit(total), SKETCH)}
    for i, q in enumerate(QUARTILES.values(), 1):
        low, high = q * F.col("__least") - 1 / F.col("__n"), q * F.col("__most") + 2 / F.col("__n")
        a, b = bracket(points, low, high, SKETCH)
        ends |= {f"__lo{i}": a, f"__hi{i}": b, f"__w{i}": inside_at_most(high - low, F.col("__n"), SKETCH)}
    targets = len(QUARTILES) + 1
    names = [f"__{c}{i}" for i in range(targets) for c in ("lo", "hi", "w")]
    state, most = measured(state.withColumns(ends).select(by, "__n", "__m", *names), targets, "brackets")
    if most > KEEP:
        return None
    got = materialize(counted(x, [by], state, targets, True), "box")
    # the cut from all groups' counts around its bracket, which they share
    one = got.agg(F.sum("__n").alias("__n"), F.first("__lo0").alias("__lo0"), F.first("__hi0").alias("__hi0"),
                  *[F.sum(f"__{c}0").alias(f"__{c}0") for c in "blh"], F.max("__u0").alias("__u0"), F.min("__o0").alias("__o0"),
                  F.sort_array(F.flatten(F.collect_list("__v0"))).alias("__v0"))
    one = one.select(interpolated(0, trim_q, F.col("__n"), F.col("__n")).alias("__cut"))
    rows = got.crossJoin(F.broadcast(one))
    left = (F.col("__b0") + F.when(F.col("__lo0") <= F.col("__cut"), F.col("__l0")).otherwise(0)
            + F.size(F.filter("__v0", lambda v: v <= F.col("__cut"))) + F.when(F.col("__hi0") <= F.col("__cut"), F.col("__h0")).otherwise(0))
    rows = rows.withColumn("__left", left)  # a group's values up to the cut are the first of them in order
    return rows.select(by, "__cut", *[interpolated(i, q, F.col("__left"), F.col("__left")).alias(c)
                                      for i, (c, q) in enumerate(QUARTILES.items(), 1)])


def centroid_heatmap(centroids: DataFrame, labels: DataFrame, digits: int = 3,
                     features: Sequence[str] = tuple(CLUSTER_FEATURES)) -> DataFrame:
    """Centroid z-scores per archetype with short feature names where there are some, in display order."""
    short = dict(zip(CLUSTER_FEATURES, CENTROID_DISPLAY))
    j = centroids.join(F.broadcast(labels), centroids["cluster"] == labels["prediction"])
    cols = [round_half_up(F.col(f), digits).alias(short.get(f, f)) for f in features]
    return in_display_order(j.select("archetype", *cols), "archetype")


def simpson_deltas(b: DataFrame, digits: int = 0) -> DataFrame:
    """Long experience × usage table with each cell's difference from the no-AI cell of
    the same experience tier: the within-tier gradient."""
    cells = b.groupBy("experience_bin", "ai_usage_bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("salary_usd").alias("__m"))
    w = Window.partitionBy("experience_bin")
    base = F.max(F.when(F.col("ai_usage_bin") == NO_USAGE, F.col("__m"))).over(w)
    return cells.withColumn("__base", base).select(
        "experience_bin", "ai_usage_bin", "n",
        round_half_up("__m", digits).alias("mean_salary"),
        round_half_up(F.col("__m") - F.col("__base"), digits).alias("delta_vs_none")) \
        .orderBy("experience_bin", "ai_usage_bin")


def display_role(c) -> Column:
    """``Developer, back-end`` -> ``Back-end`` (prefix removed, first letter capitalised)."""
    c = F.col(c) if isinstance(c, str) else c
    r = F.replace(c, F.lit("Developer, "), F.lit(""))
    return F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 20)))


def role_heatmap_k(pivot: DataFrame) -> DataFrame:
    """Role × usage mean salary in thousands, display role names."""
    usage = [label for label, _ in USAGE_BINS]
    return pivot.select(display_role("primary_role").alias("role"),
                        *[(F.col(f"`{u}`") / 1000).alias(u) for u in usage]).orderBy("role")


def short_country(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for long, short in COUNTRY_SHORT_NAMES.items():
        expr = F.when(c == long, F.lit(short)) if expr is None else expr.when(c == long, F.lit(short))
    return expr.otherwise(c)


def country_display(pivot: DataFrame) -> DataFrame:
    """Country × usage table with short names and the fixed display position."""
    usage = [label for label, _ in USAGE_BINS]
    out = pivot.select(short_country("Country").alias("country"), *[F.col(f"`{u}`") for u in usage])
    return out.withColumn("position", position_in("country", COUNTRY_DISPLAY_ORDER)) \
              .orderBy(F.asc_nulls_last("position"), "country")
