"""Suffix-array removal against brute force; the merge; front coding."""

import collections
import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import suffixes
from cohortlens.llm.util import salted_join


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = collections.Counter(x[i:i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for r, x in zip(rows, texts):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if count[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_awkward_documents(docs, rows):
    short = [r for r in rows if r[0] != 85]  # the very long one has its own test
    got = suffixes.remove_repeats(docs.where("doc_id is null or doc_id <> 85"))
    assert got.where("n_removed > 0").where("decode(kept, 'UTF-8') is null").count() == 0
    got = [tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=str) == sorted(brute(short, 200), key=str)


@pytest.mark.parametrize("length,gram", [(24, 12), (40, 10)])
def test_many_partial_matches(spark, length, gram):
    rnd = random.Random(length)
    stock = ["".join(rnd.choice("ab ") for _ in range(90)) for _ in range(25)]
    rows = []
    for i in range(160):  # cut and joined anywhere, so matches end on all sides
        t = ""
        for _ in range(rnd.randrange(4)):
            s = rnd.choice(stock)
            a = rnd.randrange(60)
            t += s[a:a + rnd.randrange(10, 80)] + rnd.choice(["", "é", "q" * rnd.randrange(30)])
        rows.append((i, t))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows, length)
    for hot in (suffixes.HOT, 5):  # all grams merged, and the frequent ones string by string
        got = [tuple(r) for r in suffixes.remove_repeats(df, length=length, gram=gram, with_text=False, hot=hot)
               .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
        assert sorted(got) == sorted(want)
    assert 0 < sum(w[2] for w in want) < sum(w[1] for w in want)


def test_text_of_several_pieces(spark, monkeypatch):
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefghij ") for _ in range(700))
    filler = ["".join(rnd.choice("klmnopqrst ") for _ in range(5000)) for _ in range(3)]
    rows = [(0, filler[0] + part + filler[1] + part[100:] + filler[2]), (1, "x" + part[:400])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 200)
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    got = [tuple(r) for r in suffixes.remove_repeats(df, with_text=False)
           .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(want) and want[0][2] > 0


def test_merge_of_front_coded_runs():
    rnd = random.Random(1)
    for k in (1, 2, 3, 7, 16):
        runs, strings = [], []
        for _ in range(k):
            own = sorted("".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))).encode() for _ in range(rnd.randrange(1, 60)))
            shared, sizes, rests = suffixes.front_code(own)
            runs.append(suffixes.Run(shared, sizes, rests, len(strings)))
            strings += own
        order, lcp, texts = suffixes.merge(runs)
        assert texts == sorted(strings) and [strings[i] for i in order] == texts
        assert lcp[1:] == [suffixes.common_prefix(a, b) for a, b in zip(texts, texts[1:])]


def test_without_repeats_and_empty_table(spark, docs, no_docs):
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert 80 in got and got[80].text is None  # no text: nothing to remove
    assert 30 not in got and 1 not in got  # whole texts that repeat
    assert len(got[40].text) < len(docs.where("doc_id = 40").first().text) and got[40].n_chars == len(got[40].text)
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_salted_join_is_a_left_join(spark):
    rows = spark.createDataFrame([(i, None if i % 11 == 0 else i % 5 if i % 3 else 0) for i in range(300)], "i int, k int")
    table = rows.where("k is not null").groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("key <> 4")
    got = salted_join(rows, "k", F.col("i"), table, "key", "n", 300, least=40)
    plain = rows.join(table, F.col("k") == F.col("key"), "left")
    assert sorted(map(str, got.select("i", "k", "key", "n").collect())) == sorted(map(str, plain.select("i", "k", "key", "n").collect()))


def test_more_parts_than_the_session_asks_for(spark, docs, monkeypatch):
    """Buckets and parts follow the bytes of the input."""
    want = sorted(map(str, suffixes.remove_repeats(docs, with_text=False).collect()))
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffixes, "PART_BYTES", 1000)
    assert sorted(map(str, suffixes.remove_repeats(docs, with_text=False).collect())) == want


def test_gram_hashes_are_dealt_evenly_and_pieces_are_small(spark):
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(4000)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = suffixes.gram_rows(df, "text", 8, 200, 100, 10**12).where("bucket >= 0")
    n = [r.n for r in rows.groupBy("bucket").agg((F.sum(F.length("hashes")) / 8).alias("n")).collect()]
    assert len(n) == 8 and sum(n) > 20_000 and max(n) < 2 * min(n)  # by the hash itself, the first had nearly all
    anchors = suffixes.Anchors()
    tracemalloc.start()
    for _, data, offsets, _ in suffixes.pieces([pa.record_batch({"text": texts})], "text", 199):
        anchors.of(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50_000_000  # 21 MB; 108 MB with a megabyte of text at once


def test_every_part_gets_its_share(spark, monkeypatch):
    """The last part too: a table of some gigabytes has fewer samples than parts have places for, and what was left over met in one task."""
    rnd = random.Random(15)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(4000)) for _ in range(200)]
    df = spark.createDataFrame([(i, str(k) + t) for i, t in enumerate(texts) for k in range(2 + i % 2)], "doc_id long, text string")
    shares = []

    def counted(run_rows, parts, length, gram):
        n = [r.n for r in run_rows.groupBy("part").agg((F.sum(F.length("least")) / 2).alias("n")).collect()]
        shares.append((parts, sum(n), max(n)))
        return spark.createDataFrame([], "digest binary, start long, end long")

    monkeypatch.setattr(suffixes, "covered", counted)
    monkeypatch.setattr(suffixes, "SPLITTERS", 1)
    monkeypatch.setattr(suffixes, "PART_BYTES", 10_000)
    assert suffixes.remove_repeats(df, with_text=False).count() == 500
    (parts, total, most), = shares
    assert parts == 200 and total > 30_000 and most < total / 15  # a third of them, before


def test_splitters_are_even():
    for n in (0, 1, 5, 199, 200, 201, 399, 400, 1000):
        sampled = [i.to_bytes(2, "big") for i in range(n)]
        at = [-1 + bool(n)] + [int.from_bytes(x, "big") for x in suffixes.splitters_of(sampled, 200)] + [n]
        gaps = [b - a for a, b in zip(at, at[1:])]
        assert len(gaps) == max(1, min(n, 200)) and max(gaps) - min(gaps) <= 1


def test_the_bitmap_has_room_for_grams_that_repeat(spark, monkeypatch):
    rnd = random.Random(16)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(4000)) for _ in range(330)]
    df = spark.createDataFrame([(t,) for t in texts + ["x" + t for t in texts[:30]]], "text string")
    monkeypatch.setattr(suffixes, "BITS", 17)
    known = suffixes.repeated_grams(suffixes.gram_rows(df, "text", 8, 200, 100, 10**12), 8, 10**9)
    bits = suffixes.broadcast_bits(spark, suffixes.bitmap_slices(known, "hash", 17, 17), 2**17 // 8)
    n = suffixes.runs(df, "text", bits, None, [], 200, 100).agg(F.sum(F.length("least")) / 2).first()[0]
    assert 4000 < n < 6000  # of 27,000 suffixes those of grams that repeat, 4,500; nearly half of the others too, before
