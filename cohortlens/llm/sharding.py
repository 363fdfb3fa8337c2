"""Sharding by sampled splitters.

A size-weighted sample of keys gives quantile boundaries; records fall into the ranges between
them; the ranges' exact totals show which are overfull (a hot key fills whole ranges), and those
are subdivided by a second hash.  Prefix sums over the pieces place every record at its byte in
the global order, and the byte's shard is the record's.  DataFrame functions only; texts are
read once and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import Stages

RANGES = 256
SAMPLE = 50_000


def records(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, k1, k2``: k1 orders by text, k2 spreads rows with the same text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(key).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                     F.crc32(t).alias("text_crc32"), F.xxhash64(t).alias("k1"),
                     F.xxhash64(F.lit(5), F.col(key), t).alias("k2"))


def unit(hash64: Column) -> Column:
    """A hash as a number from 0 to below 1."""
    return F.shiftrightunsigned(hash64, 11) / F.lit(float(2**53))


def splitters(recs: DataFrame, ranges: int, sample: int, total: int) -> list[int]:
    """At most ``ranges - 1`` ascending boundaries: quantiles of about ``sample`` keys, each record drawn
    in proportion to its size (a record larger than a draw's share counts as often as it holds that)."""
    share = F.col("size") * F.lit(float(sample)) / F.lit(float(max(total, 1)))
    times = F.floor(share) + (unit(F.xxhash64("k1", "k2")) < share - F.floor(share)).cast("long")
    drawn = recs.select("k1", times.alias("times")).where("times > 0")
    # a record that is drawn several times counts so often; all draws together are about ``sample``
    drawn = drawn.select("k1", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    at = ",".join(str(i / ranges) for i in range(1, ranges))
    found = drawn.agg(F.expr(f"percentile_approx(k1, array({at}), {4 * sample})").alias("q"))  # exact ranks: the same splitters on any layout
    q = found.first()["q"]
    return sorted(set(q)) if q else []


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many boundaries are at or below the key, by a search of two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    heads = bounds[::step]
    head = F.lit(0)
    for x in heads:
        head = head + (key >= F.lit(x)).cast("int")
    rows = F.array(*[F.array(*[F.lit(x) for x in bounds[i:i + step]]) for i in range(0, len(bounds), step)])
    inner = F.size(F.filter(F.get(rows, head - 1), lambda b: b <= key))
    return F.when(head == 0, F.lit(0)).otherwise((head - 1) * step + inner)


def shard(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", ranges: int = RANGES,
          sample: int = SAMPLE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, range_id``: one row per row of ``df``.

    Law ``bytes``: a shard's bytes are its share of all, up to one record.  Null texts weigh 1 byte; null
    and repeated keys are records like any other (fully equal rows are interchangeable); an empty table
    gives no rows.  Only the two named columns are read.  Rows of equal text are neighbours unless their
    range is overfull."""
    stages = Stages(df.sparkSession, "shard")
    recs = stages.write(records(df, key, text), "records")
    n, total = recs.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    # ranges follow the number of rows, so that a range's window stays small
    ranges = max(ranges, min(4096, n // 200_000))
    bounds = splitters(recs, ranges, sample, total)
    ranged = recs.withColumn("range_id", range_of(F.col("k1"), bounds))
    ideal = max(1.0, total / ranges)
    # a table of at most ``ranges`` rows; those over twice the share are subdivided
    full = ranged.groupBy("range_id").agg(F.sum("size").alias("b")).where(F.col("b") > 2 * ideal).collect()
    parts = [1] * ranges
    for r in full:
        parts[r["range_id"]] = int(r["b"] // ideal) + 1
    parts = F.get(F.array(*[F.lit(x) for x in parts]), F.col("range_id"))
    placed = stages.write(ranged.withColumn("piece", F.floor(unit(F.col("k2")) * parts).cast("int")), "placed")
    # one row per piece: at most two a range and one more
    per = placed.groupBy("range_id", "piece").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"))
    before = Window.orderBy("range_id", "piece").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("range_id", "piece", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                     F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("range_id", "piece").orderBy("k1", "k2", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    at = placed.withColumn("b1", F.sum("size").over(inside)).withColumn("r1", F.row_number().over(inside)) \
        .join(F.broadcast(per), ["range_id", "piece"])
    middle = F.col("b0") + F.col("b1") - F.col("size") / 2
    spot = F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")
    at = stages.write(at.select("doc_id", "size", "text_crc32", "range_id", spot.alias("shard"),
                                (F.col("r0") + F.col("r1") - 1).alias("row")), "rows")
    first = at.groupBy("shard").agg(F.min("row").alias("first"))
    return at.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "range_id")


def write_shards(df: DataFrame, path: str, shards: int = 8, key: str = "doc_id", text: str = "text") -> None:
    """Writes the rows of ``df`` to ``path`` in a folder per shard, ordered by slot within files.

    Needs a key that is unique and not null, since rows find their shard by it."""
    where = shard(df, shards, key, text).select(F.col("doc_id").alias("_key"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    df.join(where, F.col(key) == F.col("_key")).drop("_key").sortWithinPartitions("_shard", "_slot") \
        .withColumnRenamed("_shard", "shard").drop("_slot").write.partitionBy("shard").parquet(path)
