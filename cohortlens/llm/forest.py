"""Approximate nearest neighbours by a hash-prefix forest, for the largest inner product.

Rows are dealt into shards of bounded size; each shard has a forest of its own: ``trees`` sorted
arrays of hash strings (32 random hyperplanes each).  A query goes down every tree to its longest
prefix match, then up in all trees at once, one bit a step, until the prefix ranges together hold
``candidates`` entries; those rows are scored exactly.  All shards answer all queries, so a
query's best of all shards are its neighbours, and recall does not fall as rows are added.

Vectors get one more coordinate that makes their norms equal, so that the angle orders them as the
inner product does.  Shards hold vectors of like norm (bands of a tenth, small ones joined as far as a
search scores all their rows) and are lifted to their own largest norm, so that the lift stays small.
Equal vectors are one entry with their smallest ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import Stages, buckets, runs_of_keys

TREES = 64
BITS = 32
CANDIDATES = 7000
SHARD_ROWS = 8192
QUERY_BLOCK = 4096
BAND = 1.1  # ratio of the largest to the smallest norm of a band


def packed(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, vec``: vectors as bytes of doubles; null, zero and non-finite ones are left out."""
    def run(batches):
        for b in batches:
            ids, vecs = [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], names=["vec_id", "vec"])

    return df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).mapInArrow(run, "vec_id long, vec binary")


class Forest:
    def __init__(self, vectors: np.ndarray, norm: float, trees: int = TREES, seed: int = 17):
        n, d = vectors.shape
        self.vectors, self.small, self.trees = vectors, vectors.astype(np.float32), trees
        self.planes = np.random.default_rng(seed).standard_normal((d + 1, trees * BITS)).astype(np.float32)
        rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0))[:, None]
        keys = self._hash(np.concatenate([self.small, rest.astype(np.float32)], axis=1))
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1).astype(np.int64)

    def _hash(self, x: np.ndarray) -> np.ndarray:
        """Hash strings as numbers, trees by rows."""
        out = np.empty((self.trees, len(x)), np.uint32)
        for a in range(0, len(x), 1024):
            bits = np.packbits((x[a:a + 1024] @ self.planes > 0).reshape(-1, self.trees, BITS), axis=2)
            out[:, a:a + 1024] = bits.view(">u4")[:, :, 0].T
        return out

    def _ranges(self, keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each tree and query, the entries that share the query's first ``level`` bits."""
        shift = (BITS - level).astype(np.int64)
        low = np.empty(keys.shape, np.int64)
        high = np.empty(keys.shape, np.int64)
        for t in range(self.trees):
            prefix = (keys[t] >> shift) << shift
            low[t] = np.searchsorted(self.keys[t], prefix)
            high[t] = np.searchsorted(self.keys[t], prefix + (np.int64(1) << shift))
        return low, high

    def search(self, queries: np.ndarray, candidates: int, best: int):
        """For each query the rows and the exact scores of at least ``best`` rows (fewer if no more are found)."""
        keys = self._hash(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)).astype(np.int64)
        # the deepest level whose ranges hold enough, found by halving: ranges only grow on the way up
        down, up = np.zeros(len(queries), np.int64), np.full(len(queries), BITS)
        while (down < up).any():
            level = (down + up + 1) // 2
            low, high = self._ranges(keys, level)
            enough = (high - low).sum(axis=0) >= candidates
            down, up = np.where(enough, level, down), np.where(enough, up, level - 1)
        low, high = self._ranges(keys, down)
        seen = np.zeros(len(self.vectors), bool)
        slack = 1e-5 * np.sqrt((self.vectors ** 2).sum(axis=1).max())
        for i, q in enumerate(queries):
            for t, (a, b) in enumerate(zip(low[:, i].tolist(), high[:, i].tolist())):
                seen[self.order[t, a:b]] = True
            rows = np.flatnonzero(seen)
            seen[rows] = False
            rough = self.small[rows] @ q.astype(np.float32)
            if len(rows) > best:  # single precision picks those that can be among the best
                edge = np.partition(rough, len(rows) - best)[len(rows) - best]
                rows = rows[rough >= edge - 2 * slack * np.sqrt(q @ q)]
            yield i, rows, np.array([float(np.dot(self.vectors[r], q)) for r in rows])


def _deal(counts: list[tuple[int, int]], shard_rows: int, scored: int) -> tuple[list[tuple[int, int, int]], int]:
    """``(band, first shard, number of shards)`` for the ``(band, rows)`` in order, and the number of all shards.

    Neighbouring bands share a shard while they hold at most ``scored`` rows, all of which a search scores."""
    out, shards, held = [], 0, scored + 1
    for band, rows in counts:
        if held + rows <= scored:
            held += rows
            out.append((band, shards - 1, 1))
            continue
        n = -(-rows // shard_rows)
        out.append((band, shards, n))
        shards, held = shards + n, rows
    return out, shards


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, candidates: int = CANDIDATES, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``df`` with the largest inner product found for each
    row of ``queries`` (same columns), without the row of the query's own id; ties go to smaller ids.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
    without an id, nor vectors of another length than most rows have (the longer of equally frequent
    lengths).  Rows repeated with id and vector count once; an empty side gives no rows."""
    spark = df.sparkSession
    stages = Stages(spark, "forest")
    rows = stages.write(packed(df, key, vector).distinct(), "rows")
    size = rows.groupBy(F.octet_length("vec").alias("b")).count().orderBy(F.desc("count"), F.desc("b")).first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.octet_length("vec") == size["b"])
    asked = packed(queries, key, vector).where(F.octet_length("vec") == size["b"]).distinct()
    # of equal vectors the k + 1 smallest ids can be neighbours; the limit applies before the shuffle
    first = Window.partitionBy("vec").orderBy("vec_id")
    classes = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1) \
        .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stages.write(classes, "classes")
    asked = stages.write(asked, "asked")

    def norms(batches):
        for b in batches:
            v = [float(np.linalg.norm(np.frombuffer(v, "<f8"))) for v in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.float64())], names=["vec", "ids", "norm"])

    classes = classes.mapInArrow(norms, "vec binary, ids array<long>, norm double")
    norm = classes.agg(F.max("norm")).first()[0]
    # counted from the largest, so that equal norms share a band whatever their rounding
    band = F.floor(F.log(F.lit(norm) / F.col("norm")) / np.log(BAND) + 1e-6).cast("int")
    counts = sorted(tuple(r) for r in classes.groupBy(band.alias("band")).count().collect())
    dealt, shards = _deal(counts, shard_rows, candidates // trees)
    dealt = spark.createDataFrame(dealt, "of int, first int, n int")
    classes = classes.withColumn("band", band).join(F.broadcast(dealt), F.col("band") == F.col("of"))
    blocks = max(1, -(-asked.count() // query_block))
    some = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    data = classes.select((F.col("first") + F.pmod(F.xxhash64("vec"), F.col("n"))).cast("int").alias("shard"), some(blocks, "block"),
                          F.lit(None).cast("long").alias("query_id"), "vec", "ids")
    ask = asked.select(some(shards, "shard"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                       F.col("vec_id").alias("query_id"), "vec", F.lit(None).cast("array<long>").alias("ids"))

    def answer(batches):
        for _, group in runs_of_keys(batches, 2):
            data = [(v, ids) for q, v, ids in group if q is None]
            ask = [(q, v) for q, v, _ in group if q is not None]
            if not data or not ask:
                continue
            vectors = np.frombuffer(b"".join(v for v, _ in data), "<f8").reshape(len(data), -1)
            wanted = np.frombuffer(b"".join(v for _, v in ask), "<f8").reshape(len(ask), -1)
            out = []
            for i, found, scores in Forest(vectors, np.sqrt((vectors * vectors).sum(axis=1).max()), trees).search(wanted, candidates, k + 1):
                own = ask[i][0]
                best = sorted((-s, vid) for r, s in zip(found.tolist(), scores.tolist()) for vid in data[r][1] if vid != own)[:k]
                out += [(own, vid, -s) for s, vid in best]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))]
                                             if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())],
                                             names=["query_id", "vec_id", "score"])

    found = data.unionByName(ask).repartition(max(buckets(spark), shards * blocks), "shard", "block").sortWithinPartitions("shard", "block") \
        .mapInArrow(answer, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
