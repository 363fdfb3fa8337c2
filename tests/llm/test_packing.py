"""Packing: an exact round trip through the tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("window", [4096, 64])
def test_pieces_put_together_are_the_documents(docs, rows, window):
    out = packing.pack(docs, PATH, window=window).collect()
    out.sort(key=lambda r: (r.sequence_id, r.offset))
    at, whole, texts = 0, [], []
    for r in out:  # gapless windows
        assert r.sequence_id * window + r.offset == at and r.offset + r.length <= window
        at += r.length
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        if r.start == 0:
            whole.append((r.doc_id, []))
        assert len(whole[-1][1]) == r.start
        whole[-1][1].extend(ids.tolist())
        if len(whole[-1][1]) == r.doc_tokens:
            texts.append((whole[-1][0], tuple(whole[-1][1])))
    t = Tokenizer.from_file(PATH)
    want = [(r[0], (*t.encode(r[1] or "", add_special_tokens=False).ids, 2)) for r in rows]
    assert sorted(texts, key=str) == sorted(want, key=str)


def encoded(texts):
    ids, n = packing._WordIds(Tokenizer.from_file(PATH)).ids(pa.array(texts, pa.string()))
    at = np.concatenate([[0], np.cumsum(n)])
    return [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])]


def test_word_cache_equals_the_tokenizer():
    t = Tokenizer.from_file(PATH)
    texts = ["it's A's 'S don't. x'S, a.b. …. é É ΣΣ İ a\x1cb <|endoftext|> <|ENDOFTEXT|> q", "HELLO!!! ÉTÉ?! '', 's. a'. 12.5, 1. ².",
             "ab.,;' c'd. '.s ..x. x.. , .", "é É. ́a", "", " \n ", "x" * 5000 + ". y", "ﬁ ǅ ß. ſ,  a b.", None, "...", "a" + "." * 300, "!"]
    want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert encoded(texts) == want
    assert [encoded([x])[0] for x in texts] == want and encoded([]) == []


def test_random_texts_equal_the_tokenizer():
    t, rnd = Tokenizer.from_file(PATH), random.Random(11)
    parts = ["a", "B", "word", "The", "don't", "'S", "'", "é", "É", "ß", "ﬁ", "İ", "Σ", "½", "٣", "12", "7", ".", ",", ";", ":", "!", "?", "...", "-", "_", "(", "#",
             " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\u3000", "\u200b", "\u0301", "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "<",
             "|", "日本", "👍🏽", "\ufeff", "\x00", "ÿ", "e\u0301"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(30))) for _ in range(20_000)]
    got = encoded(texts)
    wrong = [x for x, ids in zip(texts, got) if ids != t.encode(x, add_special_tokens=False).ids]
    assert wrong == []


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_one_python_worker_a_task(docs, monkeypatch):
    """Spark gives each Python step of a stage a worker of its own, which stays with the words it holds."""
    plans, write = [], packing.Stages.write

    def seen(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, name)

    monkeypatch.setattr(packing.Stages, "write", seen)
    packing.pack(docs, PATH)
    assert [p.count("MapInArrow") for p in plans] == [1]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_staging_takes_two_bytes_an_id_and_bounded_batches(docs, monkeypatch):
    spark, seen, write = docs.sparkSession, [], packing.Stages.write
    before = spark.conf.get(BATCH_BYTES)

    def staged(self, df, name):
        out = write(self, df, name)
        seen.append((spark.conf.get(BATCH_BYTES), out.where("length(ids) <> 2 * n").count()))
        return out

    monkeypatch.setattr(packing.Stages, "write", staged)
    packing.pack(docs, PATH)
    assert seen == [(str(packing.SLICE_BYTES), 0)]
    assert spark.conf.get(BATCH_BYTES) == before


def test_batches_hold_about_the_bytes_asked_for(spark):
    df = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 1000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    with packing.batches_of(spark, 100_000):
        n = [r.n for r in df.mapInArrow(sizes, "n long").collect()]
    assert sum(n) == 3000 and max(n) <= 101
    assert [r.n for r in df.mapInArrow(sizes, "n long").collect()] == [3000]


def test_ids_that_need_four_bytes(docs):
    """Batches with ids of 65,536 and more keep four bytes; the pieces are the same."""
    def pieces(end_id):
        out = packing.pack(docs, PATH, window=64, end_id=end_id).select("doc_id", "start", "ids", "ids_crc32").collect()
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
        return sorted(((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in out), key=str)

    small, large = pieces(65_535), pieces(65_536)
    assert sorted([(k, at, [65_536 if x == 65_535 else x for x in ids]) for k, at, ids in small], key=str) == large
    assert any(65_536 in ids for _, _, ids in large)
