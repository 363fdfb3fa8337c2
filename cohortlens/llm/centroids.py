"""Centroid clustering of integer vectors with scalar lookup tables.

Components become integers, of which few occur in a dimension.  Each staged row is a block of
vectors: per dimension the integers that occur in the block, and each vector's place among
them.  Every round tabulates, for each dimension, occurring integer and centroid, the squared
difference once; the distances of the block's vectors are then gathers from these tables and
sums, in exact 64-bit integers.  A task gives one row of sums per centroid, so a round moves
a few rows, and the driver holds only the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import Stages

DIM = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
BLOCK = 2048      # vectors of a staged row
LIMIT = 1 << 27   # integers stay below, so that 64 squared differences fit a long


def integer_rows(vectors: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part (``dim`` components, none null or not finite) and their integers floor(scale * x)."""
    vectors = pa.array(vectors) if not isinstance(vectors, pa.Array) else vectors
    size = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dim)
    flat = vectors.take(pa.array(at)).flatten()
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    whole = np.isfinite(x).all(axis=1)
    scaled = np.floor(scale * x[whole])
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component times {scale} is beyond {LIMIT}: squared distances would not fit a long")
    return at[whole], scaled.astype(np.int64)


def blocks(rows: DataFrame, key: str, vector: str, dim: int = DIM, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """``n, keys, values, ends, codes``: blocks of the vectors that take part, as places among occurring integers.

    keys: the keys' Arrow array; values, ends: the integers that occur, of all dimensions one after the
    other, and where each dimension's end; codes: 16-bit places, dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            at, x = integer_rows(b.column(1), dim, scale)
            for i in range(0, len(at), block):
                part = x[i:i + block]
                found = [np.unique(part[:, d], return_inverse=True) for d in range(dim)]
                codes = np.stack([c.reshape(-1) for _, c in found]).astype(np.uint16)  # a block has at most 65,536 vectors
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(part)], pa.int32()),
                    pa.array([b.column(0).take(pa.array(at[i:i + block])).to_pylist()], pa.list_(b.column(0).type)),
                    pa.array([np.concatenate([v for v, _ in found]).tobytes()], pa.binary()),
                    pa.array([np.cumsum([len(v) for v, _ in found]).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([codes.tobytes()], pa.binary())], names=["n", "keys", "values", "ends", "codes"])

    if not 0 < block <= 1 << 16:
        raise ValueError("block: 1 to 65,536 vectors")
    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, vector).mapInArrow(run, f"n int, keys array<{kind}>, values binary, ends binary, codes binary")


class Tables:
    """A block's lookup tables against centroids (an integer array, one row each)."""

    def __init__(self, n: int, values: bytes, ends: bytes, codes: bytes):
        self.values, self.ends = np.frombuffer(values, np.int64), np.frombuffer(ends, np.int32)
        self.codes = np.frombuffer(codes, np.uint16).reshape(len(self.ends), n)
        self.of = np.searchsorted(self.ends, np.arange(len(self.values)), "right")  # the dimension of each value

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of every vector to every centroid: one gather per dimension, summed."""
        table = (self.values[:, None] - centroids.T[self.of]) ** 2
        out, begin = np.zeros((self.codes.shape[1], len(centroids)), np.int64), 0
        for d, end in enumerate(self.ends.tolist()):
            out += table[begin:end][self.codes[d]]
            begin = end
        return out

    def sums(self, nearest: np.ndarray, k: int) -> np.ndarray:
        """Per centroid the sums of its vectors' integers, by dimension: how often each integer occurs, times it."""
        out, begin = np.zeros((k, len(self.ends)), np.int64), 0
        for d, end in enumerate(self.ends.tolist()):
            seen = np.bincount(nearest * (end - begin) + self.codes[d], minlength=k * (end - begin)).reshape(k, end - begin)
            out[:, d] = seen @ self.values[begin:end]
            begin = end
        return out


def first_centroids(rows: DataFrame, key: str, vector: str, k: int = CENTROIDS, dim: int = DIM, scale: float = SCALE) -> np.ndarray:
    """The integers of the ``k`` vectors that take part with the smallest SHA-256 of ``1:<key>``, in its order.

    Equal hashes (a repeated key) go by components; a null key comes last; fewer vectors give fewer rows."""
    whole = (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    order = F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")), 256)
    least = rows.where(whole).select(order.alias("h"), F.col(vector).alias("v")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    if not least:
        return np.zeros((0, dim), np.int64)
    return integer_rows(pa.array([r["v"] for r in least], pa.list_(pa.float64())), dim, scale)[1]


def moved(staged: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of the nearest vectors (ties: smaller number); empty ones stay."""
    k, dim = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            for n, values, ends, codes in zip(*(b.column(c).to_pylist() for c in ("n", "values", "ends", "codes"))):
                t = Tables(n, values, ends, codes)
                nearest = t.distances(centroids).argmin(axis=1)
                count += np.bincount(nearest, minlength=k)
                total += t.sums(nearest, k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
                                         names=["c", "n", "sums"])

    each = staged.select("n", "values", "ends", "codes").mapInArrow(run, "c int, n long, sums array<long>")
    dims = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dim)]
    out = centroids.copy()
    for r in each.groupBy("c").agg(F.sum("n").alias("n"), *dims).collect():  # k rows at most
        out[r["c"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dim)]
    return out


def fit(staged: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        centroids = moved(staged, centroids)
    return centroids


def assign(staged: DataFrame, centroids: np.ndarray, key: str) -> DataFrame:
    """``<key>, cluster, distance`` of every vector of the blocks."""
    kind = staged.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for i, (n, values, ends, codes) in enumerate(zip(*(b.column(c).to_pylist() for c in ("n", "values", "ends", "codes")))):
                d = Tables(n, values, ends, codes).distances(centroids)
                nearest = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("keys")[i].values, pa.array(nearest, pa.int32()),
                                                  pa.array(d[np.arange(n), nearest])], names=[key, "cluster", "distance"])

    return staged.mapInArrow(run, f"`{key}` {kind}, cluster int, distance long")


def centroid_table(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """``cluster, components, centroid_sha256`` (k rows); the digest is of the components as decimals joined by commas."""
    rows = [(i, c.tolist(), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, components array<long>, centroid_sha256 string")


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
            dim: int = DIM, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """``<key>, cluster, distance, cluster_inertia, inertia, centroid_sha256``: one row per vector that takes part.

    Vectors that are null, of another length, or hold a null or non-finite component take no part and give no
    row; repeated rows and null keys are vectors like others; without a vector there are no rows.  A component
    whose integer is beyond ``LIMIT`` is an error.  Only the two named columns are read, and a group however
    large is never brought together: assignment is a map, inertia a sum of map-side sums."""
    spark = rows.sparkSession
    stages = Stages(spark, "centroids")
    staged = stages.write(blocks(rows, key, vector, dim, scale, block), "blocks")
    centroids = first_centroids(rows, key, vector, k, dim, scale)
    if not len(centroids):
        return rows.limit(0).select(key, *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    centroids = fit(staged, centroids, rounds)
    told = stages.write(assign(staged, centroids, key), "assigned")
    per = told.groupBy(F.col("cluster").alias("c")).agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia"))
    made = per.crossJoin(total).join(centroid_table(spark, centroids), F.col("c") == F.col("cluster")) \
        .select("c", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
    return told.join(F.broadcast(made), F.col("cluster") == F.col("c")) \
        .select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
