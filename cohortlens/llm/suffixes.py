"""Suffix-array removal of repeated byte strings, by a distributed merge sort that knows common prefixes.

Which suffixes are sorted: every string of ``length`` bytes has one anchor, the position of the
smallest hash among its ``GRAM``-byte grams (the first, if equal).  Equal strings have their
anchors at the same offset, so it is enough to sort the suffixes that begin at anchors, and only
those whose gram occurs twice at all (a bitmap of fixed size says so; its false alarms cost time,
not results).

How: each task sorts its suffixes, cuts the sorted list at sampled splitters, and sends each part
as a front-coded run (length of the prefix shared with the one before, and the rest).  The task
of a part merges the runs with a loser tree whose players know their common prefix with the last
winner: players are told apart by these lengths, and bytes are compared only beyond them.  The
merge gives the sorted order and the longest common prefix of neighbours.  Then, for each offset
an anchor can have in a string, two strings are equal exactly if the suffixes share that many
bytes and the bytes before the anchors are equal.

Texts that are equal as a whole are one text in the search, and removed by their count: those that a
bitmap of the copied texts' digests names (or takes for such) come from a table that has each once.  A gram that
begins more than ``HOT`` anchors would put them all in one task (equal grams stay together); the
strings of such anchors, at most 101 each, are told apart one by one by their digests instead, which
spread over all tasks and are counted before they are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import Rolling, Stages, batches_of, bit_set, bitmap_slices, boxed, broadcast_bits, buckets, mix, raw, rows_by_bytes, \
    runs_of_keys, salted_join, schema_of

LENGTH = 200
GRAM = 100
BITS = 27
DIGEST_BITS = 23
SPLITTERS = 4096
BUCKET_BYTES = 512 << 20  # of texts, for each bucket of gram hashes (one anchor in some 50 bytes)
PART_BYTES = 256 << 20    # of texts, for each sorted part
PIECE = 256 << 10       # bytes of text in hand at once; their arrays take some hundred times as much
FLUSH = 2_000_000        # hashes a task holds before it sends them
HOT = 100_000            # anchors that one task may merge for the same gram
RUN_BYTES = 12 << 20     # bytes of the suffixes of one sorted run
BATCH_BYTES = 2 << 20    # of texts and of runs that reach Python at once
U = np.uint64


# ---------------------------------------------------------------- anchors

class Anchors:
    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.window, self.rolling = length, gram, length - gram + 1, Rolling(fold=False)

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """``row, anchor, first, last, hash`` arrays: each anchor of a chunk with the first and the last start
        of the strings it stands for.  Positions count from the chunk's begin."""
        n = len(data)
        if n < self.length:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U),)
        prefix = self.rolling.prefix(data)
        at = np.arange(n - self.gram + 1)
        hashes = self.rolling.ranges(prefix, at, at + self.gram)
        least = self._minima((hashes >> U(24) << U(24)) | at.astype(U)) & U((1 << 24) - 1)
        sizes = np.diff(offsets)
        starts = np.repeat(offsets[:-1], np.maximum(sizes - self.length + 1, 0))  # of the strings inside rows
        row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - self.length + 1, 0))
        begin = np.concatenate([[0], np.cumsum(np.maximum(sizes - self.length + 1, 0))])[:-1]
        starts = starts + np.arange(len(starts)) - begin[row]
        if not len(starts):
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U),)
        anchor = least[starts].astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
        last = np.concatenate([new[1:], [len(starts)]]) - 1
        return row[new], anchor[new], starts[new], starts[last], hashes[anchor[new]]

    def _minima(self, x: np.ndarray) -> np.ndarray:
        """Minimum of each ``window`` neighbours, from minima of blocks from their begins and ends."""
        w, n = self.window, len(x)
        padded = np.full(-(-n // w) * w, np.iinfo(U).max, U)
        padded[:n] = x
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def pieces(batches, column: str, overlap: int, skip=None):
    """``row digests, data, offsets, shift`` of bounded chunks, each distinct text once a task, without
    those whose digest has its bit set in ``skip`` (a broadcast bitmap).

    A text longer than a piece comes in pieces that share ``overlap`` bytes, so that every string lies
    in exactly one; shift: a row's begin in its text."""
    seen: set[bytes] = set()
    bits = None if skip is None else skip.value
    for b in rows_by_bytes(batches, column, PIECE):
        data, offsets = raw(b.column(b.schema.get_field_index(column)))
        names, parts, shift = [], [], []
        for a, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if e - a <= overlap:
                continue
            name = text_digest(data[a:e].tobytes())
            if name in seen or bits is not None and digest_bit(bits, name):
                continue
            seen.add(name)
            for s in range(0, e - a - overlap, PIECE):
                names.append(name)
                parts.append(data[a + s:min(e, a + s + PIECE + overlap)])
                shift.append(s)
        i = 0
        while i < len(parts):  # a long text makes a chunk of several pieces: one at a time
            j, n = i, 0
            while j < len(parts) and (j == i or n + len(parts[j]) <= 2 * PIECE):
                n += len(parts[j])
                j += 1
            yield (names[i:j], np.concatenate(parts[i:j]), np.concatenate([[0], np.cumsum([len(p) for p in parts[i:j]])]),
                   np.array(shift[i:j]))
            i = j


def text_digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def digest_bit(bits: bytes, name: bytes) -> bool:
    at = int.from_bytes(name[:8], "big") >> (64 - DIGEST_BITS)
    return bool(bits[at >> 3] >> (at & 7) & 1)


def digest_bits(spark, digests: DataFrame):
    """Bitmap of the ``digest`` column, as a broadcast variable."""
    first8 = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    return broadcast_bits(spark, bitmap_slices(digests.select(first8.alias("h")), "h", 64, DIGEST_BITS), 2**DIGEST_BITS // 8)


def native_digest(text):
    """The same of a column."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


# ---------------------------------------------------------------- sorted runs

def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = 16
    while a[known:known + step] == b[known:known + step]:
        known += step
        step *= 2
    x = int.from_bytes(a[known:known + step].ljust(step, b"\0"), "big") ^ int.from_bytes(b[known:known + step].ljust(step, b"\0"), "big")
    return known + (step * 8 - x.bit_length()) // 8 if x else n


def front_code(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as shared prefix lengths, lengths of the rests (16 bits each), and the rests."""
    shared = [0] + [common_prefix(a, b) for a, b in zip(strings, strings[1:])]
    rests = [s[n:] for s, n in zip(strings, shared)]
    return (np.array(shared, "<u2").tobytes(), np.array([len(r) for r in rests], "<u2").tobytes(), b"".join(rests))


class Run:
    """A front-coded run read from its begin: ``text`` and how much it shares with the one before."""

    __slots__ = ("shared", "sizes", "rests", "i", "at", "text", "base")

    def __init__(self, shared: bytes, sizes: bytes, rests: bytes, base: int):
        self.shared, self.sizes = np.frombuffer(shared, "<u2").tolist(), np.frombuffer(sizes, "<u2").tolist()
        self.rests, self.i, self.at, self.text, self.base = rests, -1, 0, b"", base

    def advance(self) -> int:
        """Moves on; gives the prefix shared with the text before, or -1 at the end."""
        self.i += 1
        if self.i == len(self.sizes):
            self.text = None
            return -1
        n, shared = self.sizes[self.i], self.shared[self.i]
        self.text = self.text[:shared] + self.rests[self.at:self.at + n]
        self.at += n
        return shared


def merge(runs: list[Run]) -> tuple[list[int], list[int], list[bytes]]:
    """Order (indices by run base), common prefix with the one before, and texts, by a loser tree.

    Every player keeps its common prefix with the last winner.  Of two players the one with the longer
    prefix is the smaller, and the loser's prefix with the new winner is then known too; only at equal
    lengths are bytes compared, from there on."""
    k = 1
    while k < len(runs):
        k *= 2
    players: list[Run | None] = runs + [None] * (k - len(runs))
    known = [r.advance() if r else -1 for r in players]  # -1: no more texts
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; sets the loser's known prefix with the winner."""
        x, y = known[a], known[b]
        if x > y:
            return a, b
        if y > x:
            return b, a
        if x < 0:
            return a, b
        s, t = players[a].text, players[b].text
        n = common_prefix(s, t, x)
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    winners = list(range(k))
    level = k
    while level > 1:  # the first tournament, from the leaves up
        nxt = []
        for i in range(0, level, 2):
            w, l = play(winners[i], winners[i + 1])
            loser[(level + i) // 2] = l
            nxt.append(w)
        winners, level = nxt, level // 2
    w = winners[0]
    order, lcp, texts = [], [], []
    while known[w] >= 0:
        r = players[w]
        order.append(r.base + r.i)
        lcp.append(known[w])
        texts.append(r.text)
        known[w] = r.advance()
        node = (w + k) // 2
        while node:
            w, loser[node] = play(w, loser[node])
            node //= 2
    return order, lcp, texts


# ---------------------------------------------------------------- strings that occur twice

def repeated(lcp: np.ndarray, before: list[bytes], most: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For sorted anchors, whether the string at each offset occurs twice: a row per anchor, a column per offset.

    ``before``: the bytes between the first string's start and the anchor; ``most`` and ``least``: the
    offsets of the anchor in the first and the last string it stands for."""
    n, widest = len(lcp), int(most.max()) if len(most) else 0
    left = np.zeros((n, widest), np.uint8)
    for i, b in enumerate(before):
        if b:
            left[i, :len(b)] = np.frombuffer(b[::-1], np.uint8)  # nearest byte first
    out = np.zeros((n, widest + 1), bool)
    values = np.random.default_rng(3).integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
    hashed = np.zeros(n, U)
    for o in range(widest + 1):
        if o:
            hashed = (hashed + values[left[:, o - 1]]) * U(0x9E3779B97F4A7C15)
            hashed ^= hashed >> U(29)
        group = np.cumsum(lcp < length - o)
        at = np.flatnonzero((least <= o) & (o <= most))
        if len(at) < 2:
            continue
        key = hashed[at] + group[at].astype(U) * U(0xD6E8FEB86659FD93)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        out[at[twice], o] = True
    return out


def copied_once(docs: DataFrame, text: str, copied) -> DataFrame:
    """``digest, text``: each text whose digest has its bit set, once."""
    def run(batches):
        for b in rows_by_bytes(batches, text):
            values = [(t or "").encode() for t in b.column(0).to_pylist()]
            rows = {n: v for v in values if digest_bit(copied.value, n := text_digest(v))}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary()), pa.array([v.decode() for v in rows.values()])],
                                                 names=["digest", "text"])

    return docs.select(F.col(text)).mapInArrow(run, "digest binary, text string").groupBy("digest").agg(F.first("text").alias("text"))


def gram_bit(h: np.ndarray) -> np.ndarray:
    """Hashes whose upper bits deal grams to buckets and name their bits: an anchor's own hash is small, as the least of its
    neighbours', so that by its own upper bits nearly all would share a few hundredths of the bitmap."""
    return mix(h)


def splitters_of(sampled: list[bytes], parts: int) -> list[bytes]:
    """At most ``parts - 1`` of the ascending samples, which leave as many samples in each part, the last too, or one more."""
    n = min(parts, len(sampled))
    return [sampled[i * len(sampled) // n] for i in range(1, n)]


def gram_rows(docs: DataFrame, text: str, n_buckets: int, length: int, gram: int, rate: int, skip=None) -> DataFrame:
    """``bucket, hashes``: hashes of all anchors' grams, packed; bucket -1: sampled grams for the splitters."""
    def run(batches):
        anchors, held, n = Anchors(length, gram), [], 0

        def flush():
            h = np.concatenate(held)
            where = (gram_bit(h) >> U(32)) * U(n_buckets) >> U(32)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(n_buckets + 1))
            return [(i, h[order[edges[i]:edges[i + 1]]].tobytes()) for i in np.flatnonzero(np.diff(edges)).tolist()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                              names=["bucket", "hashes"])

        for _, data, offsets, _ in pieces(batches, text, length - 1, skip):
            _, anchor, _, _, h = anchors.of(data, offsets)
            held.append(h)
            n += len(h)
            drawn = np.flatnonzero((h * U(0x9E3779B97F4A7C15) >> U(33)) % U(rate) == 0).tolist()
            if drawn:
                yield batch([(-1, b"".join(data[anchor[i]:anchor[i] + gram].tobytes() for i in drawn))])
            if n > FLUSH:
                yield batch(flush())
                held, n = [], 0
        if n:
            yield batch(flush())

    return docs.select(F.col(text)).mapInArrow(run, "bucket int, hashes binary")


def repeated_grams(rows: DataFrame, n_buckets: int, hot: int) -> DataFrame:
    """``hash, hot``: bits of grams that occur at least twice, and whether more than ``hot`` times."""
    def run(batches):
        for _, rows in runs_of_keys(batches, 1):
            h, n = np.unique(np.concatenate([np.frombuffer(x, "<u8") for (x,) in rows]), return_counts=True)
            bit = (gram_bit(h) >> U(64 - BITS)).astype(np.int64)
            for flag, chosen in ((False, (n > 1) & (n <= hot)), (True, n > hot)):
                found = np.unique(bit[chosen])
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), flag))], names=["hash", "hot"])

    return rows.where("bucket >= 0").repartition(n_buckets, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(run, "hash long, hot boolean")


def hot_strings(docs: DataFrame, text: str, hot_bits, length: int, gram: int, skip=None) -> DataFrame:
    """``string, digest, start``: every string of the anchors whose gram has its bit set, by its digest."""
    def run(batches):
        anchors, bitmap = Anchors(length, gram), np.frombuffer(hot_bits.value, np.uint8)
        for names, data, offsets, shift in pieces(batches, text, length - 1, skip):
            row, _, first, last, h = anchors.of(data, offsets)
            blob, begin, out = data.tobytes(), offsets[:-1] - shift, []
            for i in np.flatnonzero(bit_set(bitmap, gram_bit(h), BITS)).tolist():
                r = int(row[i])
                out += [(text_digest(blob[p:p + length]), names[r], p - int(begin[r])) for p in range(int(first[i]), int(last[i]) + 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.int64()))],
                                                 names=["string", "digest", "start"])

    return docs.select(F.col(text)).mapInArrow(run, "string binary, digest binary, start long")


def hot_covered(strings: DataFrame, length: int, stages: Stages) -> DataFrame:
    """``digest, start, end`` of the strings that occur twice.  They are counted before they are shuffled, and
    the places of the most frequent ones are spread over tasks."""
    twice = stages.write(strings.groupBy(F.col("string").alias("s")).agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "twice")
    places = twice.agg(F.sum("times")).first()[0] or 0
    return salted_join(strings, "string", F.struct("digest", "start"), twice, "s", "times", places).where("s is not null") \
        .select("digest", "start", (F.col("start") + length).alias("end"))


def runs(docs: DataFrame, text: str, bits, hot_bits, splitters: list[bytes], length: int, gram: int, skip=None) -> DataFrame:
    """``part, shared, sizes, rests, names, name, first, least, before``: front-coded runs with, for each
    suffix, its text (an index into ``names``), the first start, the last start's offset, and the bytes before."""
    def run(batches):
        import bisect

        anchors, bitmap, squeeze = Anchors(length, gram), np.frombuffer(bits.value, np.uint8), zstandard.ZstdCompressor(3).compress
        hot = None if hot_bits is None else np.frombuffer(hot_bits.value, np.uint8)
        held: list[tuple] = []
        size = 0

        def flush():
            held.sort(key=lambda x: x[0])
            # a part's border never parts equal grams
            edges = [0] + [bisect.bisect_left(held, c, key=lambda x: x[0][:gram]) for c in splitters] + [len(held)]
            rows = []
            for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a == b:
                    continue
                own = held[a:b]
                names = list(dict.fromkeys(x[2] for x in own))
                index = {x: i for i, x in enumerate(names)}
                shared, sizes, rests = front_code([x[0] for x in own])
                rows.append((part, shared, sizes, squeeze(rests), b"".join(names),
                             np.array([index[x[2]] for x in own], "<u4").tobytes(), np.array([x[3] for x in own], "<i8").tobytes(),
                             np.array([x[4] for x in own], "<u2").tobytes(), np.array([len(x[1]) for x in own], "<u2").tobytes(),
                             squeeze(b"".join(x[1] for x in own))))
            held.clear()
            types = [pa.int32()] + [pa.binary()] * 9
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=RUN_COLUMNS)

        for names, data, offsets, shift in pieces(batches, text, length - 1, skip):
            row, anchor, first, last, h = anchors.of(data, offsets)
            bit = gram_bit(h)
            hit = bit_set(bitmap, bit, BITS)
            hit = np.flatnonzero(hit if hot is None else hit & ~bit_set(hot, bit, BITS))
            blob = data.tobytes()
            begin = (offsets[:-1] - shift)[row[hit]]
            for r, s, a, e, z in zip(row[hit].tolist(), anchor[hit].tolist(), first[hit].tolist(), last[hit].tolist(), begin.tolist()):
                held.append((blob[s:e + length], blob[a:s], names[r], a - z, s - e))
                size += e + length - a
            if size > RUN_BYTES:
                yield flush()
                size = 0
        if held:
            yield flush()

    return docs.select(F.col(text)).mapInArrow(run, ", ".join([RUN_COLUMNS[0] + " int"] + [c + " binary" for c in RUN_COLUMNS[1:]]))


RUN_COLUMNS = ["part", "shared", "sizes", "rests", "names", "name", "first", "least", "before_sizes", "before"]


def covered(run_rows: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """``digest, start, end``: byte ranges covered by strings that occur twice (ranges may overlap)."""
    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for _, rows in runs_of_keys(batches, 1):
            players, names, name, first, least, before = [], [], [], [], [], []
            for shared, sizes, rests, own, idx, f, l, bs, b in rows:
                players.append(Run(shared, sizes, expand(rests), sum(map(len, first))))
                name.append(np.frombuffer(idx, "<u4").astype(np.int64) + len(names))
                names += [own[i:i + 16] for i in range(0, len(own), 16)]
                first.append(np.frombuffer(f, "<i8"))
                least.append(np.frombuffer(l, "<u2").astype(np.int64))
                at = np.concatenate([[0], np.cumsum(np.frombuffer(bs, "<u2").astype(np.int64))]).tolist()
                b = expand(b)
                before += [b[i:j] for i, j in zip(at[:-1], at[1:])]
            del rows
            order, lcp, texts = merge(players)
            del texts, players
            order, lcp = np.array(order), np.array(lcp)
            name, first, least = (np.concatenate(x)[order] for x in (name, first, least))
            before = [before[i] for i in order.tolist()]
            most = np.array([len(b) for b in before])
            # an anchor whose suffix shares less than a gram with both neighbours stands alone
            near = lcp >= gram
            busy = near | np.concatenate([near[1:], [False]])
            # of neighbours in between, none is left out: a lone one breaks every group, as does the first kept after it
            twice = repeated(lcp[busy], [x for x, k in zip(before, busy.tolist()) if k], most[busy], least[busy], length)
            name, first, most = name[busy], first[busy], most[busy]
            if not len(twice):
                continue
            # offset o belongs to start first + most - o: turn columns into ascending starts, and find their runs
            step = np.diff(np.pad(twice.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            r, o0 = np.nonzero(step == 1)
            _, o1 = np.nonzero(step == -1)
            start, end = first[r] + most[r] - (o1 - 1), first[r] + most[r] - o0 + length
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in name[r].tolist()], pa.binary()), pa.array(start), pa.array(end)],
                                             names=["digest", "start", "end"])

    return run_rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, "digest binary, start long, end long")


def texts_with_bit(docs: DataFrame, text: str, bits) -> DataFrame:
    """``doc_id, digest, n_bytes, whole_sha256`` of each row, and the ``bytes`` of the text where the digest's bit is set."""
    schema = schema_of(docs.select("doc_id"), digest="binary", n_bytes="long", whole_sha256="string", bytes="binary")

    def run(batches):
        bitmap = np.frombuffer(bits.value, np.uint8)
        for b in rows_by_bytes(batches, text):
            data, offsets = raw(b.column(1))
            blobs = [data[a:e].tobytes() for a, e in zip(offsets[:-1], offsets[1:])]
            whole = [hashlib.sha256(x) for x in blobs]
            hit = bit_set(bitmap, np.array([int.from_bytes(x.digest()[:8], "big") for x in whole], U), DIGEST_BITS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.digest()[:16] for x in whole], pa.binary()), pa.array(np.diff(offsets)),
                 pa.array([x.hexdigest() for x in whole]),
                 pa.array([x if h else None for x, h in zip(blobs, hit.tolist())], pa.binary())], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   with_text: bool = True, hot: int = HOT) -> DataFrame:
    """``doc_id, digest, n_bytes, n_removed, n_spans, kept_sha256, kept, kept_text, spans``: one row per row of ``docs``.

    Removes each byte covered by a string of ``length`` bytes that starts at another place too, in any text.
    kept (binary) and kept_text (without broken characters): what is left, null if nothing was removed.  A null text is empty; texts shorter than
    ``length`` stay; repeated rows remove each other; keys may be null or repeated; an empty table gives
    no rows.  Only the two named columns are read."""
    spark = docs.sparkSession
    stages = Stages(spark, "suffixes")
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    text = "text"
    names = stages.write(docs.select(native_digest(F.col("text")).alias("digest"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes")), "names")
    total = names.agg(F.sum("n_bytes")).first()[0] or 0
    # what a task holds at once follows from these, not from the input: some 10 million hashes, 256 MB of texts
    n, parts = max(buckets(spark), total // BUCKET_BYTES), max(4 * buckets(spark), total // PART_BYTES)
    drawn = max(SPLITTERS, 4 * parts)
    rate = max(1, total * 2 // (length - gram + 2) // drawn)
    copies = names.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    copied = digest_bits(spark, copies.where("copies > 1"))
    with batches_of(spark, BATCH_BYTES):
        once = stages.write(copied_once(docs, text, copied), "once")
        # the texts that are there once, and one of each of the others
        both = lambda f, *options: f(docs, text, *options, copied).unionByName(f(once, "text", *options))
        grams = stages.write(both(gram_rows, n, length, gram, rate), "grams")
        # about SPLITTERS grams of 100 bytes, or 100 bytes for each 64 MB of a very large input
        sampled = sorted({x for r in grams.where("bucket = -1").select("hashes").collect()
                          for x in (bytes(r[0][i:i + gram]) for i in range(0, len(r[0]), gram))})
        splitters = splitters_of(sampled, parts)
        known = stages.write(repeated_grams(grams, n, hot), "repeated")
        stages.drop("grams")
        bits = broadcast_bits(spark, bitmap_slices(known.where("not hot"), "hash", BITS, BITS), 2**BITS // 8)
        some_hot = known.where("hot")
        hot_bits = None if some_hot.isEmpty() else broadcast_bits(spark, bitmap_slices(some_hot, "hash", BITS, BITS), 2**BITS // 8)
        ranges = covered(both(runs, bits, hot_bits, splitters, length, gram), parts, length, gram)
        if hot_bits is not None:
            ranges = ranges.unionByName(hot_covered(both(hot_strings, hot_bits, length, gram), length, stages))
        found = stages.write(ranges, "found")
    stages.drop("once")
    spans = found.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    known = stages.write(copies.join(spans, "digest", "left").where("copies > 1 or spans is not null"), "spans")
    stages.drop("found")
    cut = digest_bits(spark, known.where("copies = 1"))
    rows = texts_with_bit(docs, text, cut).join(known, "digest", "left")
    more = {"kept": "binary", "kept_text": "string", "spans": "array<struct<start:long,end:long>>"} if with_text else {}
    schema = schema_of(rows.select("doc_id", "digest", "n_bytes"), n_removed="long", n_spans="long", kept_sha256="string", **more)
    return rows.select("doc_id", "digest", "n_bytes", "whole_sha256", "bytes", "copies", "spans").mapInArrow(_cut(length, with_text, schema), schema)


def _cut(length: int, with_text: bool, schema):
    def run(batches):
        names = schema.names
        for b in rows_by_bytes(batches, "bytes"):
            out = []
            for d, name, n, whole, data, copies, spans in zip(*(b.column(i) for i in range(7))):
                n, copies = n.as_py(), copies.as_py() or 1
                if copies > 1 and n >= length:
                    merged, left, sha = [(0, n)], b"", hashlib.sha256(b"").hexdigest()
                elif copies == 1 and spans.is_valid:
                    flat = spans.values.flatten()
                    merged = union(flat[0].to_numpy(zero_copy_only=False), flat[1].to_numpy(zero_copy_only=False))
                    data = data.as_py()
                    left, at = [], 0
                    for s, e in merged:
                        left.append(data[at:s])
                        at = e
                    left = b"".join(left + [data[at:]])
                    sha = hashlib.sha256(left).hexdigest()
                else:
                    merged, left, sha = [], None, whole.as_py()
                row = [d.as_py(), name.as_py(), n, sum(e - s for s, e in merged), len(merged), sha]
                if with_text:
                    row += [left, left if left is None else left.decode("utf-8", "ignore"), [{"start": s, "end": e} for s, e in merged]]
                out.append(row)
            types = [b.column(0).type, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            types += [pa.binary(), pa.string(), b.column(6).type] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return run


def union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Ascending maximal runs of the given ranges; ranges that touch are one."""
    order = np.argsort(start, kind="stable")
    start, top = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > top[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return list(zip(start[new].tolist(), top[last].tolist()))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (text, ...) without the repeated bytes; n_chars follows the text if there is one.

    A cut can leave a part of a character at its ends; those bytes go too.  A row whose whole text goes is
    dropped; rows without a text stay.  Changed texts find their rows by the digest."""
    columns = docs.columns
    made = remove_repeats(docs.select(F.lit(0).alias("doc_id"), "text"), length=length).where("n_removed > 0") \
        .select(F.col("digest").alias("g"), F.col("kept_text").alias("left")).dropDuplicates(["g"])
    out = boxed(docs, digest=native_digest(F.col("text"))).join(made, F.col("digest") == F.col("g"), "left") \
        .where("g is null or left <> ''")
    made_of = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return out.select(*[F.when(F.col("g").isNotNull(), made_of[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in made_of
                        else F.col(f"row.`{c}`").alias(c) for c in columns])
