"""Embedding near-duplicates by randomised-rotation binary codes.

A random rotation turns a unit vector o into signs (its binary code x) and one number stored
with them, the correction f = <x, o>.  For another unit vector q, <x, q> / f estimates <o, q>
without bias, and misses it by about sqrt(1 - <o, q>**2) * sqrt((1 - f**2) / f**2 / (D - 1)) times a
standard normal.  So a pair whose estimate is further than ``SURE`` of these below the
threshold cannot be a link, but for a chance of some 1e-7, and only the others are computed
exactly.  As q, a vector travels as 8-bit steps of its rotated components, whose rounding the bound allows for.

Pairs meet in hash tables: a table's key is a run of sign bits of further rotations, long
enough for buckets of some thousand vectors, and there are as many tables as find a pair at the
threshold itself with probability ``RECALL`` (closer pairs: nearer to 1).  Equal vectors are
one vector with a count.  Two passes over the buckets:

1. codes alone are dealt to the buckets; a vector is active in a bucket if a pair of its own
   there may be a link and shares no earlier table (so each pair has one bucket);
2. active vectors bring their components, and cosines are computed in double precision.

Neither pass gives pairs: the first gives active vectors, the second a count of links for each
vector, and links that connect the bucket's vectors as all of its links do.  Buckets of more than twice
``BLOCK`` vectors are settled in pairs of blocks, so a task never holds more than two.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import Stages, buckets, components, salted_join

THRESHOLD = 0.9
RECALL = 0.995   # of pairs at the threshold; 0.9998 at a cosine of 0.95
SURE = 5.0       # standard deviations below the threshold that rule a pair out
LEAST_BITS = 8
BUCKET = 4096    # vectors of a bucket, on average, once the table is large
BLOCK = 4096
TILE = 512
KEYS = ["dim", "t", "band", "x", "y"]


def tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a key, and the number of tables, for ``n`` vectors."""
    bits = max(LEAST_BITS, round(math.log2(max(n, 1) / BUCKET)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


@lru_cache(256)
def rotation(dim: int, i: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([20240901, dim, i]).standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


@lru_cache(16)
def _dither(dim: int) -> np.ndarray:
    return np.random.default_rng([20240902, dim]).random(dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bands(u: np.ndarray, bits: int, n_tables: int) -> np.ndarray:
    """Keys of unit vectors in every table."""
    dim, need = u.shape[1], bits * n_tables
    signs = np.concatenate([u @ rotation(dim, 1 + i) >= 0 for i in range(-(-need // dim))], axis=1)[:, :need]
    return signs.reshape(len(u), n_tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def code_type(dim: int, n_tables: int) -> np.dtype:
    return np.dtype([("code", "u1", (-(-dim // 8),)), ("steps", "u1", (dim,)), ("low", "<f4"), ("step", "<f4"), ("f", "<f4"),
                     ("bands", "<i4", (n_tables,))])


def codes(u: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Code, 8-bit steps, correction and keys of each unit vector."""
    dim = u.shape[1]
    y = u @ rotation(dim, 0)
    out = np.zeros(len(u), code_type(dim, keys.shape[1]))
    out["code"] = np.packbits(y >= 0, axis=1)
    low = y.min(axis=1)
    step = np.maximum((y.max(axis=1) - low) / 254, 1e-12)
    out["steps"] = np.floor((y - low[:, None]) / step[:, None] + _dither(dim)).astype(np.uint8)
    out["low"], out["step"], out["f"] = low, step, np.abs(y).sum(axis=1) / math.sqrt(dim)
    out["bands"] = keys
    return out


class Side:
    """Codes of a block, unpacked: as data (signs), and as queries (rotated components)."""

    def __init__(self, c: np.ndarray, dim: int, threshold: float):
        self.signs = np.unpackbits(c["code"], axis=1)[:, :dim].astype(np.float32) * 2 - 1
        self.rotated = c["steps"] * c["step"][:, None] + c["low"][:, None]
        f = c["f"]
        self.scale = 1 / (f * np.float32(math.sqrt(dim)))
        spread = np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / max(dim - 1, 1))
        self.least = threshold - SURE * math.sqrt(1 - threshold**2) * spread - 1e-5
        self.slack, self.step, self.bands = 2 / f, c["step"], c["bands"]

    def may_link(self, i: slice, other: "Side", j: slice) -> np.ndarray:
        """Which pairs neither side's estimate rules out."""
        a = (self.signs[i] @ other.rotated[j].T) * self.scale[i, None] + self.slack[i, None] * other.step[None, j] >= self.least[i, None]
        b = (self.rotated[i] @ other.signs[j].T) * other.scale[None, j] + other.slack[None, j] * self.step[i, None] >= other.least[None, j]
        return a & b


def _first_meeting(found: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """Of the pairs ``found``, those whose keys differ in all tables before ``t``."""
    i, j = np.nonzero(found)
    for s in range(t):
        apart = a[i, s] != b[j, s]
        i, j = i[apart], j[apart]
    out = np.zeros_like(found)
    out[i, j] = True
    return out


def _tiles(own: np.ndarray, x: int, y: int):
    """``(rows, begin)`` pairs: tiles of one block's rows, and where the rows to compare with begin (in the same
    block: themselves and what follows)."""
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    for k in range(0, len(left), TILE):
        yield left[k:k + TILE], right[k:] if x == y else right


def _pairs(rows: np.ndarray, others: np.ndarray, found: np.ndarray, x: int, y: int) -> np.ndarray:
    return found & (others[None, :] > rows[:, None]) if x == y else found


def groups(batches, n_keys: int):
    """``(key values, columns)`` of each run of equal keys; columns: Arrow arrays of the other columns."""
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy() for i in range(n_keys)])
        edges = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [b.num_rows]])
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            now = tuple(k[:, i].tolist())
            if now != key and held:
                yield key, [pa.concat_arrays(c) for c in zip(*held)]
                held = []
            key = now
            held.append([b.column(c).slice(i, j - i) for c in range(n_keys, b.num_columns)])
    if held:
        yield key, [pa.concat_arrays(c) for c in zip(*held)]


def _fixed(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _vectors(column: pa.Array, kind) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows that take part (not null, not zero, no null or non-finite component), and by dimension their places and values."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    good, by = np.zeros(len(column), bool), {}
    for dim in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == dim)
        x = column.take(pa.array(at)).flatten().cast(kind).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(at), dim)
        ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        good[at[ok]] = True
        by[dim] = (at[ok], x[ok] + x.dtype.type(0))  # no negative zero
    return good, by


def _digests(rows: DataFrame, key: str, vector: str, with_vector: bool) -> DataFrame:
    """``vec_id, v`` of every row (v: 16-byte digest of the vector, null if it takes no part), or with its ``dim`` and ``vec`` (bytes)."""
    element = rows.schema[vector].dataType.elementType.simpleString()
    kind = pa.float32() if element == "float" else pa.float64()
    id_type = rows.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            _, by = _vectors(b.column(1), kind)
            v, dims, vec = [None] * b.num_rows, [None] * b.num_rows, [None] * b.num_rows
            for dim, (at, x) in by.items():
                for i, r in zip(at.tolist(), x):
                    data = r.tobytes()
                    v[i], dims[i], vec[i] = hashlib.blake2b(data, digest_size=16, salt=dim.to_bytes(8, "little")).digest(), dim, data
            more = [pa.array(dims, pa.int32()), pa.array(vec, pa.binary())] if with_vector else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(v, pa.binary()), *more],
                                             names=["vec_id", "v"] + ["dim", "vec"] * with_vector)

    return rows.select(key, vector).mapInArrow(run, f"vec_id {id_type}, v binary" + ", dim int, vec binary" * with_vector)


def _dealt(vectors: DataFrame, kind: str, bits: int, n_tables: int) -> DataFrame:
    """``dim, t, band, v, code``: every vector's code in its bucket of every table."""

    def run(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                u = unit(_fixed(b.column(2).take(at), kind).astype(np.float64).reshape(len(at), dim))
                keys = bands(u, bits, n_tables)
                c = codes(u, keys)
                data, v = pa.array([r.tobytes() for r in c], pa.binary()), b.column(0).take(at)
                for t in range(n_tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(c), dim, np.int32)), pa.array(np.full(len(c), t, np.int32)), pa.array(keys[:, t]), v, data],
                        names=["dim", "t", "band", "v", "code"])

    return vectors.select("v", "dim", "vec").mapInArrow(run, "dim int, t int, band long, v binary, code binary")


def _in_blocks(dealt: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds x, y, own: the pair of blocks that a row takes part in, and its own block; more than one only in
    buckets of more than twice ``BLOCK`` vectors, which come salted to the join that tells their size."""
    salt = 16
    large = sizes.where(F.col("n") > 2 * BLOCK).select(
        F.col("dim").alias("d"), F.col("t").alias("s"), F.col("band").alias("b"), F.ceil(F.col("n") / BLOCK).cast("int").alias("m"),
        F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("z"))
    h = F.xxhash64("v")
    rows = dealt.join(large, (F.col("dim") == F.col("d")) & (F.col("t") == F.col("s")) & (F.col("band") == F.col("b"))
                      & (F.pmod(h, F.lit(salt)).cast("int") == F.col("z")), "left").withColumn("m", F.coalesce("m", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.shiftright(h, 8), F.col("m")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    return rows.select("dim", "t", "band", F.least("own", "j").alias("x"), F.greatest("own", "j").alias("y"), "own", "v", "code")


def _active(rows: DataFrame, parts: int, n_tables: int, threshold: float) -> DataFrame:
    """``dim, t, band, x, y, own, v`` of the rows with a pair in their group that may be a link and meets there first."""

    def run(batches):
        for key, (own, v, code) in groups(batches, len(KEYS)):
            dim, t, _, x, y = key
            if len(v) < 2:
                continue
            side = Side(_fixed(code, code_type(dim, n_tables)), dim, threshold)
            own, live = own.to_numpy(), np.zeros(len(v), bool)
            for i, j in _tiles(own, x, y):
                found = _pairs(i, j, side.may_link(i, side, j), x, y)
                if found.any():
                    found = _first_meeting(found, side.bands[i], side.bands[j], t)
                    live[i] |= found.any(axis=1)
                    live[j] |= found.any(axis=0)
            at = pa.array(np.flatnonzero(live))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k), ty) for k, ty in zip(key, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
                    + [pa.array(own[live], pa.int32()), v.take(at)], names=[*KEYS, "own", "v"])

    return rows.repartition(parts, *KEYS).sortWithinPartitions(*KEYS).mapInArrow(
        run, "dim int, t int, band long, x int, y int, own int, v binary")


class Forest:
    """Links that connect what all links seen do: at most one less than the vectors."""

    def __init__(self, n: int):
        self.name, self.links = np.arange(n), []

    def add(self, i: int, js: np.ndarray) -> None:
        names, first = np.unique(self.name[js], return_index=True)
        for name, k in zip(names.tolist(), first.tolist()):
            if name != self.name[i]:
                self.links.append((i, int(js[k])))
                self.name[self.name == name] = self.name[i]


def _links(rows: DataFrame, parts: int, kind: str, bits: int, n_tables: int, threshold: float) -> DataFrame:
    """``a, b, n`` of groups of active vectors: links (a, b) that connect as all links do (n null), and each
    vector's (a, b null) number of linked vectors that meet it first in this group, copies counted."""

    def run(batches):
        for key, (own, v, copies, vec) in groups(batches, len(KEYS)):
            dim, t, _, x, y = key
            if len(v) < 2:
                continue
            values = _fixed(vec, kind).astype(np.float64).reshape(len(v), dim)
            u, own, copies = unit(values), own.to_numpy(), copies.to_numpy()
            keys, count, forest = bands(u, bits, n_tables), np.zeros(len(v), np.int64), Forest(len(v))
            for i, j in _tiles(own, x, y):
                found = _pairs(i, j, u[i] @ u[j].T >= threshold, x, y)
                found = _first_meeting(found, keys[i], keys[j], t)
                count[i] += found @ copies[j]
                count[j] += copies[i] @ found
                for r in np.flatnonzero(found.any(axis=1)).tolist():
                    forest.add(int(i[r]), j[found[r]])
            names = v.to_pylist()
            some = np.flatnonzero(count).tolist()
            if some:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in some] + [names[i] for i, _ in forest.links], pa.binary()),
                     pa.array([None] * len(some) + [names[j] for _, j in forest.links], pa.binary()),
                     pa.array(count[some].tolist() + [None] * len(forest.links), pa.int64())], names=["a", "b", "n"])

    return rows.repartition(parts, *KEYS).sortWithinPartitions(*KEYS).mapInArrow(run, "a binary, b binary, n long")


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``rows``.

    n_links: other rows linked directly (cosine of at least ``threshold``), copies counted; component_id: the
    smallest key reachable by links, itself included; kept: the key is its component's.  Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, and vectors of different lengths do not
    link; equal vectors and repeated rows link with each other; a null key is never the smallest unless all are
    null (then kept).  An empty table gives no rows.  Only the two named columns are read.

    Links are exact; a pair at the threshold is found with probability ``recall``, a closer one more surely."""
    if not 0 < threshold < 1:
        raise ValueError("threshold: between 0 and 1")
    spark = rows.sparkSession
    stages = Stages(spark, "neardup")
    kind = "<f4" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    told = stages.write(_digests(rows, key, vector, False), "rows")
    vectors = _digests(rows, key, vector, True).where("v is not null").groupBy("v").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    vectors = stages.write(vectors, "vectors")
    n, dim = vectors.agg(F.count(F.lit(1)), F.max("dim")).first()
    bits, n_tables = tables(n, threshold, recall)
    # partitions follow the bytes of a pass: about 32 MB each
    parts = max(buckets(spark), n * n_tables * (code_type(dim or 1, n_tables).itemsize + 48) >> 25)
    dealt = _dealt(vectors, kind, bits, n_tables)
    sizes = stages.write(dealt.groupBy("dim", "t", "band").agg(F.count(F.lit(1)).alias("n")), "sizes")
    active = stages.write(_active(_in_blocks(dealt, sizes), parts, n_tables, threshold), "active")
    brought = active.join(vectors.select(F.col("v").alias("w"), "n", "vec"), F.col("v") == F.col("w")) \
        .select(*KEYS, "own", "v", "n", "vec")
    found = stages.write(_links(brought, parts, kind, bits, n_tables, threshold), "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("ca")).agg(F.sum("n").alias("linked"))
    comp = stages.write(components(found.where("b is not null").select("a", "b"), stages), "components")
    named = stages.write(vectors.select("v", "least", "n").join(counts, F.col("v") == F.col("ca"), "left")
                         .join(comp.select(F.col("v").alias("cv"), "c"), F.col("v") == F.col("cv"), "left")
                         .select("v", "least", "c", "n", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "named")
    # a component or vector may hold a third of the rows: what the rows look up is salted, where it is large
    least = named.where("c is not null").groupBy(F.col("c").alias("k")).agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    named = salted_join(named, "c", F.col("v"), least, "k", "size", n).select("v", "n", "n_links", F.coalesce("component_id", "least").alias("component_id"))
    named = stages.write(named, "classes").withColumnRenamed("v", "k")
    total = told.count()
    out = salted_join(told, "v", F.struct("vec_id"), named, "k", "n", total)
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
