"""Sharding by bytes: whole, even, gapless; overfull ranges are subdivided."""

import collections
import zlib

from cohortlens.llm import sharding


def check(out, rows, shards):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=str) == sorted(
        ((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    slots, bytes_ = collections.defaultdict(list), collections.Counter()
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(bytes_.values()), max(size(t) for _, t in rows)
    assert all(abs(b - total / shards) <= largest for b in bytes_.values())


def test_awkward_documents(docs, rows):
    check(sharding.shard(docs).collect(), [r[:2] for r in rows], 8)


def test_hot_text_is_subdivided(spark):
    rows = [(i, "hot text") for i in range(3000)] + [(3000 + i, f"text {i}") for i in range(3000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), ranges=32).collect()
    check(out, rows, 8)
    assert len({r.shard for r in out if r.doc_id < 3000}) > 1
    assert sorted(map(tuple, sharding.shard(spark.createDataFrame(rows[::-1], "doc_id long, text string"), ranges=32).collect()),
                  key=str) == sorted(map(tuple, out), key=str)  # reruns agree


def test_range_of_is_the_number_of_boundaries(spark):
    from pyspark.sql import functions as F

    bounds = [-50, -7, 0, 3, 3 + 10**12, 10**15, 10**16]
    keys = sorted({b + d for b in bounds for d in (-1, 0, 1)})
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.range_of(F.col("k"), bounds)).collect()
    assert [r[1] for r in sorted(got)] == [sum(b <= k for b in bounds) for k in keys]


def test_written_shards_and_empty_table(spark, no_docs, tmp_path):
    assert sharding.shard(no_docs).count() == 0
    df = spark.createDataFrame([(i, "t" * (i % 40)) for i in range(300)], "id long, text string")
    sharding.write_shards(df, str(tmp_path / "s"), shards=4, key="id")
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 300 and back.select("shard").distinct().count() == 4
