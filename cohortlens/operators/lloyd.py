"""K-Means from fixed starting points: the same centres on any layout, all k in the same scans.

Starts are rows chosen by the smallest hashes of their id, so they follow from the data alone.
Each step reads the feature columns once for every k that still moves: a task assigns its rows
with NumPy and gives, per k and cluster, a count and per-column sums and sums of squares; a
step moves a few rows per task, and the driver holds the centres only.

Distances are in units of the columns' standard deviations, without a scaled copy of the data:
the squared differences of the raw columns are weighed by one over the variance.  Sums of whole
numbers are exact (64-bit in a task, decimals between tasks), so with integer columns the fit
does not depend on the layout to the last bit; with doubles, up to rounding.  It ends when no
centre moves, or after ``max_iter`` steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import with_delta_cost

ROWS = 4096  # rows of a block in a task


@dataclass(frozen=True)
class Sums:
    """Per group: rows, and the sums of each column and of its squares."""

    n: list[int]
    total: list[list]
    squares: list[list]


@dataclass(frozen=True)
class Model:
    """Centres in the columns' own units, and the sums of the rows nearest to each."""

    cols: tuple[str, ...]
    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]
    nearest: Sums
    steps: int

    @property
    def weights(self) -> np.ndarray:
        """One over the variance; a constant column has no weight."""
        return np.array([1 / (s * s) if s else 0.0 for s in self.deviation])

    def scaled(self) -> list[list[float]]:
        """Centres as z-scores."""
        return [[(x - m) / s if s else 0.0 for x, m, s in zip(c, self.mean, self.deviation)] for c in self.centres]


def complete_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns of the rows without a null, as longs if all are whole numbers, else doubles."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols)
    return df.select(*[F.col(c).cast("long" if whole else "double").alias(c) for c in cols]).dropna()


def _blocks(batches, dtype):
    for b in batches:
        x = np.stack([c.to_numpy() for c in b.columns], axis=1).astype(dtype)
        for i in range(0, len(x), ROWS):
            yield x[i:i + ROWS]


def _distances(x: np.ndarray, centres: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted squared distances, column by column in their order (as the SQL adds them)."""
    out = np.zeros((len(x), len(centres)))
    for f, w in enumerate(weights):
        diff = x[:, f, None] - centres[None, :, f]
        out += w * (diff * diff)
    return out


def grouped_sums(points: DataFrame, centres: Mapping[int, Sequence[Sequence[float]]], weights: Sequence[float]) -> dict[int, Sums]:
    """Sums of the points nearest to each centre (ties: the first), for every entry of ``centres``, in one scan
    of ``points`` (``complete_points``)."""
    d, whole = len(points.columns), isinstance(points.schema[0].dataType, T.LongType)
    dtype = np.int64 if whole else np.float64
    models = {k: np.array(c, np.float64) for k, c in centres.items()}
    weights = np.array(weights, np.float64)

    def run(batches):
        sums = {k: np.zeros((len(c), 2 * d + 1), dtype) for k, c in models.items()}  # rows, columns, squares
        for x in _blocks(batches, dtype):
            each = np.concatenate([np.ones((len(x), 1), dtype), x, x * x], axis=1)
            for k, c in models.items():
                label = _distances(x, c, weights).argmin(axis=1) if len(c) > 1 else np.zeros(len(x), np.int64)
                order = np.argsort(label, kind="stable")
                found, first = np.unique(label[order], return_index=True)
                sums[k][found] += np.add.reduceat(each[order], first, axis=0)
        for k, s in sums.items():
            c, i = np.indices(s.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), k, np.int32)), pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(s.ravel())], names=["k", "c", "i", "x"])

    each = points.mapInArrow(run, f"k int, c int, i int, x {'long' if whole else 'double'}")
    total = each.groupBy("k", "c", "i").agg(F.sum(F.col("x").cast("decimal(38,0)") if whole else F.col("x")).alias("x"))
    out = {k: Sums([0] * len(c), [[0] * d for _ in c], [[0] * d for _ in c]) for k, c in models.items()}
    for k, c, i, x in total.collect():  # 2d + 1 rows per centre
        if i == 0:
            out[k].n[c] = int(x)
        else:
            (out[k].total if i <= d else out[k].squares)[c][(i - 1) % d] = int(x) if whole else x
    return out


def column_scales(points: DataFrame) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """The columns' means and sample deviations (one scan); zeros without a point."""
    d = len(points.columns)
    s = grouped_sums(points, {1: [[0.0] * d]}, [0.0] * d)[1]
    n = s.n[0]
    if n == 0:
        return (0.0,) * d, (0.0,) * d
    mean = tuple(float(t) / n for t in s.total[0])
    spread = [max(n * q - t * t, 0) for t, q in zip(s.total[0], s.squares[0])]  # exact for whole numbers
    return mean, tuple(float(np.sqrt(float(v) / (float(n) * (n - 1)))) if n > 1 else 0.0 for v in spread)


def start_points(df: DataFrame, cols: Sequence[str], key: str, k: int, seed: int = 42) -> list[list[float]]:
    """The ``k`` first different points in the order of SHA-256 of ``<seed>:<key>`` (fewer if there are no more).

    Only the smallest hashes are looked at, and more of them as long as they hold too few points."""
    hashed = df.dropna(subset=list(cols)).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256).alias("h"),
                                                 F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    take = 16 * k
    while True:
        rows = hashed.orderBy(F.asc_nulls_last("h"), "x").limit(take).collect()
        found = list(dict.fromkeys(tuple(r["x"]) for r in rows))
        if len(found) >= k or len(rows) < take:
            return [list(x) for x in found[:k]]
        take *= 16


def fit(df: DataFrame, ks: Sequence[int], cols: Sequence[str], key: str, max_iter: int = 40, seed: int = 42,
        go_on: Mapping[int, Model] | None = None) -> dict[int, Model]:
    """A model for each of ``ks``; the steps of all run in the same scans, each k until its centres stand still.

    ``go_on``: models of the same rows, columns and seed whose steps are continued instead of taken again; the
    result is the same."""
    points, go_on = complete_points(df, cols), dict(go_on or {})
    known = next(iter(go_on.values()), None)
    mean, deviation = (known.mean, known.deviation) if known else column_scales(points)
    moving, done = {k: m.centres for k, m in go_on.items() if k in ks}, {k: m.steps for k, m in go_on.items()}
    if any(k not in moving for k in ks):
        starts = start_points(df, cols, key, max(ks), seed)
        if not starts:
            raise ValueError("no row has all features")
        moving |= {k: tuple(tuple(c) for c in starts[:k]) for k in ks if k not in moving}
    weights = Model(tuple(cols), mean, deviation, (), Sums([], [], []), 0).weights
    out: dict[int, Model] = {}
    while moving:
        for k, s in grouped_sums(points, moving, weights).items():
            new = tuple(tuple(float(t) / m for t in total) if m else c for c, m, total in zip(moving[k], s.n, s.total))
            if new == moving[k] or done.get(k, 0) >= max_iter:
                out[k] = Model(tuple(cols), mean, deviation, moving.pop(k), s, done.get(k, 0))
            else:
                moving[k], done[k] = new, done.get(k, 0) + 1
    return {k: out[k] for k in ks}


def score(df: DataFrame, models: Mapping[int, Model]) -> DataFrame:
    """``k, wssse, silhouette`` of every model from one scan.

    With each cluster's count, sums and sums of squares, the mean distance of a point to a cluster is a closed
    form, so both figures are sums over the rows; per task and k one row of them leaves the task."""
    first = next(iter(models.values()))
    points = complete_points(df, first.cols)
    dtype, w = np.int64 if isinstance(points.schema[0].dataType, T.LongType) else np.float64, first.weights
    plans = {k: (np.array(m.centres), np.array(m.nearest.n), np.array([[float(v) for v in r] for r in m.nearest.total]),
                 np.array([sum(w[i] * float(v) for i, v in enumerate(r)) for r in m.nearest.squares])) for k, m in models.items()}

    def run(batches):
        seen, cost, sil = 0, dict.fromkeys(plans, 0.0), dict.fromkeys(plans, 0.0)
        for x in _blocks(batches, dtype):
            seen += len(x)
            norm = (x * x).astype(np.float64) @ w
            for k, (c, n, total, squares) in plans.items():
                d = _distances(x, c, w)
                own, rows = d.argmin(axis=1), np.arange(len(x))
                cost[k] += d[rows, own].sum()
                some = np.maximum(n, 1)
                apart = norm[:, None] + squares / some - 2 * (x * w) @ (total / some[:, None]).T  # mean distance to each cluster
                a = apart[rows, own] * n[own] / np.maximum(n[own] - 1, 1)
                apart[rows, own] = np.inf
                apart[:, n == 0] = np.inf
                b = apart.min(axis=1)
                top = np.maximum(a, b)
                good = (n[own] > 1) & np.isfinite(b) & (top > 0)
                sil[k] += ((b - a)[good] / top[good]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(list(plans), pa.int32()), pa.array([seen] * len(plans), pa.int64()),
                                          pa.array(list(cost.values())), pa.array(list(sil.values()))], names=["k", "n", "cost", "sil"])

    each = points.mapInArrow(run, "k int, n long, cost double, sil double")
    return each.groupBy("k").agg(F.sum("cost").alias("wssse"), (F.sum("sil") / F.sum("n")).alias("silhouette"))


def sweep_table(df: DataFrame, models: Mapping[int, Model]) -> DataFrame:
    """Elbow and silhouette table ``(k, wssse, silhouette, delta_cost)``."""
    return with_delta_cost(score(df, models))


def assign(df: DataFrame, model: Model, out: str = "prediction") -> DataFrame:
    """The rows that have all features, with the nearest centre (ties: the first); columns only, no join."""
    def distance(c) -> Column:
        total = None
        for col, x, w in zip(model.cols, c, model.weights.tolist()):
            diff = F.col(col).cast("double") - F.lit(x)
            term = F.lit(w) * (diff * diff)
            total = term if total is None else total + term
        return total

    best = F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(j).alias("c")) for j, c in enumerate(model.centres)]))
    return df.dropna(subset=list(model.cols)).withColumn(out, best["c"])


def centroid_table(spark: SparkSession, model: Model, cid: str = "cluster") -> DataFrame:
    """Centres as z-scores: ``(cluster, <feature>...)`` (k rows)."""
    schema = f"`{cid}` int, " + ", ".join(f"`{c}` double" for c in model.cols)
    return spark.createDataFrame([(j, *c) for j, c in enumerate(model.scaled())], schema)
