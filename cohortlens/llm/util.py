"""Shared helpers: staged tables in the cluster's shared folder, bounded text chunks, word hashes."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20


# ---------------------------------------------------------------- staged tables

def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local master without that
    setting gets a folder of its own, under the session's warehouse."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") \
        or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-stages"
    return path.rstrip("/")


class Stages:
    """Tables written once to the shared folder to cut lineage.  Results read them lazily: call ``drop``
    (or ``drop_all`` for every operator's tables of this process) once they are written or collected."""

    made: list["Stages"] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        Stages.made.append(self)

    @classmethod
    def drop_all(cls, keep: list["Stages"] = ()) -> None:
        for s in [s for s in cls.made if s not in keep]:
            s.drop()
            cls.made.remove(s)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def buckets(spark: SparkSession, per_partition: int = 1) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * per_partition


def schema_of(df: DataFrame, **more: str) -> T.StructType:
    """The fields of ``df`` and then ``more`` (name=type), all nullable."""
    fields = [T.StructField(f.name, f.dataType) for f in df.schema]
    return T.StructType(fields + [T.StructField(k, T._parse_datatype_string(v)) for k, v in more.items()])


def boxed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row of ``docs`` as one column ``row``, next to the given ones: names cannot clash, and
    ``select("row.*")`` gives the rows back."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in columns.items()])


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text without building an array of them; null: 0."""
    return F.coalesce(F.length(F.regexp_replace(F.concat(F.lit(" "), text), WORD, "w"))
                      - F.length(F.regexp_replace(F.concat(F.lit(" "), text), WORD, "")), F.lit(0)).cast("long")


# ---------------------------------------------------------------- text in tasks

def rows_by_bytes(batches, column: str, limit: int = CHUNK_BYTES):
    """Slices of the Arrow batches whose texts hold about ``limit`` bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0)
        at = np.concatenate([[0], np.cumsum(n.to_numpy(zero_copy_only=False).astype(np.int64))])
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


@contextmanager
def batches_of(spark: SparkSession, n_bytes: int):
    """Jobs run inside hand their rows to Python in Arrow batches of about ``n_bytes`` (one row at least), not of 10,000 rows
    or 64 MB: a task holds its batch as vectors, as a stream and in Python, in buffers of up to twice that size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, one row after the other, and the rows' offsets (null: empty)."""
    a = pa.array(column) if not isinstance(column, pa.Array) else column
    a = a.cast(pa.large_binary())
    if a.null_count:
        a = pc.fill_null(a, b"")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any byte range of a buffer, by prefix sums.

    Each byte stands for a random 64-bit value.  ``fold`` maps A-Z to a-z first."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, fold: bool):
        values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold:
            values[65:91] = values[97:123]
        self.values, self.power, self.inverse = values, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 2**64))):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:len(data)], dtype=np.uint64, out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and of each row the index of its first word (with one more at the end)."""
    word = ~SEPARATOR[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def broadcast_bits(spark: SparkSession, slices: DataFrame, n_bytes: int):
    """A bitmap of fixed size from ``(at long, bits binary)`` slices, as a broadcast variable.

    The slices together hold ``n_bytes``, whatever the input; one job fetches them."""
    bits = np.zeros(n_bytes, np.uint8)
    for r in slices.collect():
        part = np.frombuffer(r["bits"], np.uint8)
        bits[r["at"]:r["at"] + len(part)] |= part
    return spark.sparkContext.broadcast(bits.tobytes())


def bit_set(bits: np.ndarray, hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """Whether the bit of each hash (its upper bits) is set."""
    at = hashes >> np.uint64(64 - n_bits)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


# ---------------------------------------------------------------- connected components

def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``(v, c)`` for each vertex of the links ``(a, b)``; c: a vertex that stands for its component.

    Each round hooks every vertex to its smallest neighbour and contracts the links to those;
    vertices are hashes, so links shrink by a constant factor in expectation.  Nothing is collected."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = stages.write(both.where("a <> b").distinct(), "links-0")
    maps, k = [], 0
    while True:
        p = stages.write(e.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), f"hooks-{k}")
        maps.append(p)
        nxt = (e.join(p, "a").select(F.col("p").alias("x"), "b")
                .join(p.select(F.col("a").alias("b"), F.col("p").alias("y")), "b")
                .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        k += 1
        e = stages.write(nxt, f"links-{k}")
        if e.isEmpty():
            break
    out = maps[-1]
    for m in reversed(maps[:-1]):
        out = m.join(out.select(F.col("a").alias("q"), F.col("p").alias("r")), F.col("p") == F.col("q"), "left") \
            .select("a", F.coalesce("r", "p").alias("p"))
    return out.select(F.col("a").alias("v"), F.col("p").alias("c"))


# ---------------------------------------------------------------- joins on hot keys

def salted_join(rows: DataFrame, by: str, spread, table: DataFrame, key: str, weight: str, total: int, salts: int = 64,
                least: int = 10_000) -> DataFrame:
    """Left join of ``rows`` to ``table`` (one row per ``key``) on ``by``; keys whose ``weight`` is more than ``least`` and
    a thousandth of ``total``, the sum of weights (so at most a thousand keys, which are broadcast), are spread by ``spread``."""
    hot = table.where(F.col(weight) > max(least, total // 1000)).select(F.col(key).alias("_hot"))
    part = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")
    left = rows.join(F.broadcast(hot), F.col(by) == F.col("_hot"), "left").withColumn("_salt", part).drop("_hot")
    many = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_z", F.explode(many)).drop("_hot")
    return left.join(right, (F.col(by) == F.col(key)) & (F.col("_salt") == F.col("_z")), "left").drop("_salt", "_z")


# ---------------------------------------------------------------- sorted partitions in tasks

def runs_of_keys(batches, keys: int):
    """``(key values, rows)`` of each run of equal keys in a partition sorted by its first ``keys`` columns.

    Rows are tuples of the other columns; a run may go over batches."""
    current, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield current, rows


def low_bytes(x: np.ndarray, n: int) -> bytes:
    """The ``n`` low bytes of each 64-bit number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def from_low_bytes(b: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(b) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(b, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel()


def bitmap_slices(hashes: DataFrame, column: str, width: int, n_bits: int, slices: int = 64) -> DataFrame:
    """``(at, bits)`` slices of a bitmap of 2**n_bits bits; bit: the upper bits of ``column``, a long
    of ``width`` bits (64: signed)."""
    bit = F.shiftrightunsigned(F.col(column), width - n_bits)
    per = 2**n_bits // slices
    rows = hashes.select((bit / per).cast("int").alias("slice"), bit.alias("bit"))

    def run(pdf):
        import pandas as pd

        at = np.unique(pdf["bit"].to_numpy()) - int(pdf["slice"].iloc[0]) * per
        bits = np.zeros(per, bool)
        bits[at] = True
        return pd.DataFrame({"at": [int(pdf["slice"].iloc[0]) * per // 8], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return rows.distinct().groupBy("slice").applyInPandas(run, "at long, bits binary")
