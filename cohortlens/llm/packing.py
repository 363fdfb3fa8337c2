"""Packing by concatenate and cut.

Pass one tokenizes and stages each document's ids with its start within the partition; the
partitions' token totals (one row each) become global offsets by a prefix sum; pass two cuts
at the window borders, row by row, so a document over several windows gives one record per
piece.  No shuffle: only the totals leave the tasks.  Ids are staged in two bytes where they fit,
and texts reach Python in batches of some megabytes.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .util import SEPARATOR, Stages, batches_of, raw, rows_by_bytes, schema_of, word_spans

WINDOW = 4096
END_ID = 2


@lru_cache(2)
def _word_ids(path: str) -> "_WordIds":
    """One cache of words per Python worker, whatever the number of its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    return _WordIds(Tokenizer.from_file(path))


#: ASCII letters are 1; ASCII symbols 2, but for those that begin a contraction (') or are in special tokens (<|>).
_KIND, _LOWER = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[np.frombuffer(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~", np.uint8)] = 2
_LOWER[65:91] += 32


class _WordIds(dict):
    """Ids, as little-endian bytes, of words by cache: runs of bytes without ASCII white space, cut between ASCII
    letters and symbols (where the tokenizer cuts too)."""

    LIMIT = 250_000  # words of a generation; there are two, so that what is used stays

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.bytes = tokenizer, tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.old: dict[bytes, bytes] = {}

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        words, first = self._words(*raw(column))
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(len(column), np.int64)
        coded = words.dictionary_encode()
        each, at = self._lookup(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        pool, start = np.frombuffer(b"".join(each), "<u4"), np.cumsum(size) - size
        n = size[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = pool[np.repeat(start[at] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, np.diff(ends[first])

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words of a buffer of texts, and of each text the number of its first word (with one more at the end)."""
        s, _, first = word_spans(data, offsets)
        low = _LOWER[data]  # the tokenizer lower-cases itself, but finds its special tokens before that
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) else data
        for row in np.unique(np.searchsorted(offsets, special, "right") - 1).tolist():
            low[offsets[row]:offsets[row + 1]] = data[offsets[row]:offsets[row + 1]]
        kind = _KIND[data]
        cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1  # never a white space, so only texts' borders are to be left out
        cuts = np.setdiff1d(cuts, offsets, assume_unique=False)
        begins = np.sort(np.concatenate([s, cuts]))
        first = first + np.searchsorted(cuts, offsets)
        word = ~SEPARATOR[data]
        size = np.add.reduceat(word, begins, dtype=np.int64) if len(begins) else begins
        held = low[word]
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(held)]), first

    def __missing__(self, word: bytes) -> bytes:
        got = self.old.get(word)
        if got is None:
            got = array("I", self._encoded(word)).tobytes()
        self[word] = got
        return got

    def _lookup(self, words: list[bytes]) -> list[bytes]:
        if len(self) > self.LIMIT:
            self.old = dict(self)
            self.clear()
        return list(map(self.__getitem__, words))

    def _encoded(self, word: bytes) -> list[int]:
        """A word of letters that the tokenizer would not change is one piece for its model; others go all the way."""
        if word.isalpha() and word.islower():  # ASCII letters
            return [t.id for t in self.model.tokenize(word.decode())]
        text = word.decode()
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            return [t.id for t in self.model.tokenize(self.bytes.pre_tokenize_str(text)[0][0])]
        return self.tokenizer.encode(text, add_special_tokens=False).ids


SLICE_BYTES = 2 << 20


def _tokenized(batches, tokenizer_path: str, keep: list[str], text: str, end_id: int | None, narrow: bool = False):
    """Record batches of the columns ``keep``, n and ids; narrow: two bytes an id in batches where all ids fit."""
    words = _word_ids(tokenizer_path)
    for b in rows_by_bytes(batches, text, SLICE_BYTES):
        ids, n = words.ids(b.column(b.schema.get_field_index(text)))
        if end_id is not None:
            ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
        if narrow and ids.max(initial=0) < 1 << 16:
            ids = ids.astype("<u2")
        bounds = np.concatenate([[0], ids.itemsize * np.cumsum(n)])
        if bounds[-1] < 1 << 31:
            held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)])
        else:  # a text of its own that is this long
            held = pa.array([ids[i:j].tobytes() for i, j in zip(bounds[:-1] // ids.itemsize, bounds[1:] // ids.itemsize)], pa.binary())
        out = {c: b.column(b.schema.get_field_index(c)) for c in keep}
        yield pa.RecordBatch.from_pydict(out | {"n": pa.array(n, pa.int64()), "ids": held})


def tokenize(df: DataFrame, tokenizer_path: str, text: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Adds ``ids`` (binary, unsigned 32-bit little-endian) and ``n`` to the other columns.

    For word-wise byte-pair tokenizers that lower-case and drop white space (``word_bpe``): words between
    white space are encoded apart, each once for a slice of some megabytes.  A null text has only the end id."""
    keep = [c for c in df.columns if c != text]
    schema = schema_of(df.select(*keep), n="long", ids="binary")
    return df.select(*keep, text).mapInArrow(lambda batches: _tokenized(batches, tokenizer_path, keep, text, end_id), schema)


def pack(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         window: int = WINDOW, end_id: int | None = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    Every row of ``df`` is a document (repeated rows and null keys too); a null or empty text
    has just the end id; an empty table gives no rows.  Only the last window is not full.
    Only ``key`` and ``text`` are read, so other columns cannot clash."""
    spark = df.sparkSession
    stages = Stages(spark, "pack")
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = schema_of(docs.select("key"), n="long", ids="binary", part="int", at="long")

    def number(batches):
        """In one pass with the words: a second one would take a Python worker more per core, which stays with its memory."""
        part, at = TaskContext.get().partitionId(), 0
        for b in _tokenized(batches, tokenizer_path, ["key"], "text", end_id, narrow=True):
            n = b.column("n").to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("n"), b.column("ids"), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(ends - n)], names=["key", "n", "ids", "part", "at"])
            at = int(ends[-1]) if len(n) else at

    with batches_of(spark, SLICE_BYTES):
        staged = stages.write(docs.mapInArrow(number, schema), "ids")
    totals = staged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row per partition
    base = dict(zip((r["part"] for r in totals), np.cumsum([0] + [r["n"] for r in totals])[:-1].tolist()))
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    out_schema = schema_of(staged.select(F.col("key").alias(key)), **dict.fromkeys(names, "long"), **({"ids": "binary"} if with_ids else {}))
    base = spark.sparkContext.broadcast(base)

    def cut(batches):
        for b in rows_by_bytes(batches, "ids"):
            rows: list[list] = [[] for _ in out_schema]
            for k, n, ids, part, at in zip(*(b.column(i) for i in range(5))):
                n, ids = n.as_py(), ids.as_py()
                ids = memoryview(ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                begin = base.value[part.as_py()] + at.as_py()
                done = 0
                while done < n:
                    sequence, offset = divmod(begin + done, window)
                    length = min(n - done, window - offset)
                    piece = ids[4 * done:4 * (done + length)]
                    row = [k.as_py(), done, length, zlib.crc32(piece), n, sequence, offset]
                    for column, x in zip(rows, row + [bytes(piece)] * with_ids):
                        column.append(x)
                    done += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(rows, [b.column(0).type] + [pa.int64()] * 6 + [pa.binary()] * with_ids)],
                names=out_schema.names)

    return staged.select("key", "n", "ids", "part", "at").mapInArrow(cut, out_schema)
