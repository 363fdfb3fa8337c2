"""N-gram Jaccard join with PartEnum signatures; exact links at a similarity of 0.8 or more.

A document's set holds the hashes of its five-word shingles.  Sets fall into size bands, each
0.8 of the next; two sets that link lie in one band or in neighbours, and differ in at most
k = 2/9 of the upper band's largest size elements.  For a band the hash domain is cut into n1
ranges, so that one of them has at most k2 differences, and that range into n2, of which all but
k2 agree: every choice of n2 - k2 of them gives one signature, and linked sets share one.

Signatures, not sets, are shuffled for the search (11 bytes each, packed by bucket).  Sets that
share signatures meet at the smallest set hash of each signature's group, first by sketches: cells
of the hash domain with four bits each, of which linked sets cannot differ in more than k.  Only
sets that this bound leaves together are shuffled, and every link among them is settled exactly
(large groups in pairs of blocks).  A spanning forest of the links goes to connected components.
Equal sets are one vertex throughout, so thousands of copies cost as much as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import (Rolling, Stages, bit_set, bitmap_slices, boxed, broadcast_bits, buckets, components, from_low_bytes, low_bytes,
                   mix, raw, rows_by_bytes, runs_of_keys, schema_of, word_spans)

SHINGLE = 5
#: similarity as a fraction: 100 * intersection >= 80 * union
NUM, DEN = 80, 100
BLOCK = 2000
BITS = 26
FLUSH = 400_000
#: bytes of text in hand at once: their arrays of 64-bit numbers take some sixty times as much
SLICE_BYTES = 256 << 10
#: buckets of signatures for each partition: a task holds the arrays of one bucket, and some of many deal out evenly
BUCKETS = 4
#: signatures of a bucket that are sorted at once
PIECE = 1 << 17
U = np.uint64


class Shingles:
    """Sorted distinct shingle hashes of each text of a chunk."""

    def __init__(self, words: int = SHINGLE):
        self.k, self.rolling = words, Rolling(fold=True)
        self.odd = np.random.default_rng(71).integers(1, 2**62, words, dtype=np.uint64) * U(2) + U(1)

    def sets(self, column: pa.Array) -> list[np.ndarray]:
        data, offsets = raw(column)
        starts, ends, first = word_spans(data, offsets)
        word = self.rolling.ranges(self.rolling.prefix(data), starts, ends)
        n = max(0, len(word) - self.k + 1)
        full = np.zeros(n, U)
        for j in range(self.k):
            full += word[j:j + n] * self.odd[j]
        full = mix(full)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= self.k:
                out.append(np.unique(full[a:b - self.k + 1]))
            elif b > a:
                out.append(mix(np.array([(word[a:b] * self.odd[:b - a]).sum(dtype=U) + U(b - a)], U)))
            else:
                out.append(np.zeros(0, U))
        return out


def text_sets(batches):
    """Slices of the batches and the sets of their column ``text``."""
    shingles = Shingles()
    for b in rows_by_bytes(batches, "text", SLICE_BYTES):
        yield b, shingles.sets(b.column("text"))


def digest(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mix(s ^ U(0x1234567)).sum(dtype=U), mix(s + U(0x7654321)).sum(dtype=U) + U(len(s))], U).tobytes()


def short_hash(d: bytes) -> int:
    """48 bits of a digest, by which sets meet; what meets is told apart by the digest."""
    return int.from_bytes(d[:6], "little")


def bands(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Last size of each band, and how many elements sets may differ in if the larger lies in the band."""
    last = [1]
    while last[-1] < largest:
        last.append((last[-1] + 1) * DEN // NUM)
    last = np.array(last)
    return last, 2 * last * (DEN - NUM) // (DEN + NUM)


class PartEnum:
    """Signatures of sets (sorted arrays of 64-bit hashes)."""

    SMALL = 11  # up to so many differences: n1 ranges with k2 = 1 out of n2 = 4; beyond: k2 = 0, ranges alone
    N2 = 4
    DEPTH = 4

    def __init__(self):
        self.last, self.differ = bands(1 << 34)

    def of(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.zeros(0, U)
        band = int(np.searchsorted(self.last, len(s)))
        return np.concatenate([self._band(s, b, b, 0) for b in (band, band + 1) if self.differ[b] > 0] or [np.zeros(0, U)])

    def _band(self, s: np.ndarray, band: int, tag: int, depth: int) -> np.ndarray:
        k = int(self.differ[band])
        small = k <= self.SMALL
        # k + 1 ranges would do; some more leave enough of them that hold elements
        n1 = (k + 2) // 2 if small else k + 4 + k // 12
        cells = n1 * (self.N2 if small else 1)
        edges = np.zeros(cells + 1, np.int64)
        edges[1:-1] = np.searchsorted(s, (np.arange(1, cells, dtype=U) * U(2**64 // cells)))
        edges[-1] = len(s)
        total = np.zeros(len(s) + 1, U)
        np.cumsum(mix(s ^ U(0x5851F42D4C957F2D)), dtype=U, out=total[1:])
        sums, counts = total[edges[1:]] - total[edges[:-1]], np.diff(edges)
        if small:
            sums, counts = sums.reshape(n1, -1), counts.reshape(n1, -1)
            sums = (sums.sum(axis=1, dtype=U, keepdims=True) - sums).ravel()
            counts = (counts.sum(axis=1, keepdims=True) - counts).ravel()
        tags = mix(np.arange(len(sums), dtype=U) + U(tag * 0x9E3779B97F4A7C15 % 2**64))
        out = mix(sums + tags)
        if depth == self.DEPTH:
            return out
        held = counts > 0
        if small:  # instead of a signature of nothing: those of another cut of the domain, for this place
            again = [int(t) for t in tags[~held]]
        else:  # more than k ranges hold elements: one of those agrees; else also by another cut
            again = [] if held.sum() > k else [int(mix(np.array([tag], U))[0])]
        other = np.sort(mix(s + U(depth + 1))) if again else s
        return np.concatenate([out[held], *(self._band(other, band, t, depth + 1) for t in again)])


def linked(a: int, b: int, common) -> np.ndarray:
    return DEN * common >= NUM * (a + b - common)


def spanning(n: int, probe) -> list[tuple[int, int]]:
    """Links among ``n`` items that connect exactly what all links would.

    ``probe(x)`` gives all links of one item; items of the largest component so far need none."""
    group, probed, out = np.arange(n), np.zeros(n, bool), []
    while True:
        largest = np.bincount(group, minlength=n).argmax()
        todo = np.flatnonzero(~probed & (group != largest)) if probed.any() else np.array([0])
        if not len(todo):
            return out
        x = int(todo[0])
        probed[x] = True
        hit = probe(x)
        for y in hit[group[hit] != group[x]].tolist():
            if group[y] != group[x]:
                out.append((x, y))
                group[group == group[y]] = group[x]


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets."""
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if linked(len(sets[0]), len(sets[1]), common) else []
    sizes = np.array([len(s) for s in sets])
    flat, at = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])
    values, ids = np.unique(flat, return_inverse=True)
    mark = np.zeros(len(values), bool)

    def probe(x: int) -> np.ndarray:
        mine = ids[at[x]:at[x + 1]]
        mark[mine] = True
        common = np.add.reduceat(mark[ids].astype(np.int64), at[:-1])
        mark[mine] = False
        return np.flatnonzero(linked(sizes[x], sizes, common))

    return spanning(len(sets), probe)


def sketch(s: np.ndarray) -> bytes:
    """Four bits for each of 2**j cells of the hash domain (as many cells as elements or up to twice as
    many): the sum of the elements' four-bit hashes.  Two cells add up to one of the next coarser sketch."""
    j = max(3, (len(s) - 1).bit_length())
    y = mix(s ^ U(0x2F6B8C1D5A3E7791))
    cells = np.bincount((y >> U(64 - j)).astype(np.int64), weights=(y & U(15)).astype(np.float64), minlength=1 << j)
    cells = cells.astype(np.int64).astype(np.uint8) & 15
    return (cells[::2] | cells[1::2] << 4).tobytes()


def near_forest(sizes: np.ndarray, sketches: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of all pairs that may link by size and by the cells in which they differ."""
    cells = [np.frombuffer(x, np.uint8) for x in sketches]
    cells = [np.stack([c & 15, c >> 4], axis=1).ravel() for c in cells]
    level = np.array([len(c) for c in cells])
    rows = {n: np.flatnonzero(level == n) for n in set(level.tolist())}
    full = {n: np.stack([cells[i] for i in r.tolist()]) for n, r in rows.items()}
    fold = lambda x: (x[..., ::2] + x[..., 1::2]) & 15
    half = {n: fold(m) for n, m in full.items()}

    def probe(x: int) -> np.ndarray:
        n, own, found = len(cells[x]), cells[x], []
        for other, table, mine in ((n, full, own), (2 * n, half, own), (n // 2, full, fold(own))):
            if other in rows:
                r = rows[other]
                total = sizes[r] + sizes[x]
                may = (DEN * np.minimum(sizes[r], sizes[x]) >= NUM * np.maximum(sizes[r], sizes[x])) \
                    & ((table[other] != mine).sum(axis=1) <= total * (DEN - NUM) // (DEN + NUM))
                found.append(r[may])
        return np.concatenate(found)

    return spanning(len(sketches), probe)


def classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest, fp, sketch`` (the last three null for a text without words) of each row."""
    src = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    schema = schema_of(src.select("doc_id", "text_hash"), n_shingles="long", digest="binary", fp="long", sketch="binary")

    def run(batches):
        for b, sets in text_sets(batches):
            names = [digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
                 pa.array([None if d is None else short_hash(d) for d in names], pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], names=schema.names)

    return src.mapInArrow(run, schema)


def shared_signatures(s: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Rows ``fp, center``, each once: the sets (hashes ``f``) that share one of the signatures ``s``, with the smallest of its group."""
    order = np.lexsort((f, s))
    s, f = s[order], f[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (f[1:] != f[:-1])])  # each set once in a group
    s, f = s[new], f[new]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    size = np.diff(np.concatenate([first, [len(s)]]))
    center, shared = np.repeat(f[first], size), np.repeat(size > 1, size)
    return np.unique(np.stack([f[shared], center[shared]], axis=1), axis=0).astype(np.int64)


def meet(batches):
    """``fp, center`` of batches ``bucket, sigs, fps`` sorted by bucket; a pair may come several times."""
    for (_,), rows in runs_of_keys(rows_by_bytes(batches, "sigs"), 1):
        s = np.concatenate([from_low_bytes(x, 5) for x, _ in rows])
        f = np.concatenate([from_low_bytes(x, 6) for _, x in rows])
        rows.clear()
        n = -(-len(s) // PIECE)
        piece = s % U(n)  # equal signatures stay together
        for k in range(n):
            at = piece == k
            if at.any():
                pairs = shared_signatures(s[at], f[at])
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["fp", "center"])


def meetings(docs: DataFrame, text: str, parts: int) -> DataFrame:
    """``fp, center``: sets (by short hash) that share a signature, with the smallest of its group."""
    n_buckets = parts * BUCKETS

    def emit(batches):
        enum, seen = PartEnum(), set()
        sigs, fps, n = [], [], 0

        def flush():
            s, f = np.concatenate(sigs), np.concatenate(fps)
            # the bucket takes the upper bits of a signature, and the row keeps the 40 lower ones
            where = ((s >> U(40)) % U(n_buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            s, f, edges = s[order], f[order], np.searchsorted(where[order], np.arange(n_buckets + 1))
            for i in np.flatnonzero(np.diff(edges)).tolist():
                a, b = edges[i], edges[i + 1]
                yield i, low_bytes(s[a:b], 5), low_bytes(f[a:b], 6)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "sigs", "fps"])

        for _, sets in text_sets(batches):
            for s in sets:
                if len(s) and (fp := short_hash(digest(s))) not in seen:
                    seen.add(fp)
                    x = enum.of(s)
                    if len(x):
                        sigs.append(x)
                        fps.append(np.full(len(x), fp, U))
                        n += len(x)
            if n > FLUSH:
                yield batch(list(flush()))
                sigs, fps, n = [], [], 0
        if n:
            yield batch(list(flush()))

    rows = docs.select(F.col(text).alias("text")).mapInArrow(emit, "bucket int, sigs binary, fps binary")
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "fp long, center long").distinct()


def active_sets(docs: DataFrame, text: str, bits) -> DataFrame:
    """``fp, digest, members``: the sets whose bit is set, each once a task."""

    def run(batches):
        seen, bitmap = set(), np.frombuffer(bits.value, np.uint8)
        for _, sets in text_sets(batches):
            rows = []
            for s in sets:
                if len(s) and (d := digest(s)) not in seen:
                    seen.add(d)
                    rows.append((short_hash(d), d, s))
            if rows:
                fp = np.array([r[0] for r in rows], U)
                hit = np.flatnonzero(bit_set(bitmap, fp << U(16), BITS)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[hit].astype(np.int64)), pa.array([rows[i][1] for i in hit], pa.binary()),
                     pa.array([low_bytes(rows[i][2], 6) for i in hit], pa.binary())], names=["fp", "digest", "members"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "fp long, digest binary, members binary")


def in_blocks(met: DataFrame, group: str, block: int) -> DataFrame:
    """``met`` (fp and ``group``) with block numbers ``x, y``: a group of more than ``block`` sets comes as all
    pairs of its blocks, others as one."""
    large = met.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("g")).where("g > 1")
    i = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda j: F.struct(F.least(i, j).alias("x"), F.greatest(i, j).alias("y")))
    return met.join(large, group, "left").withColumn("g", F.coalesce("g", F.lit(1))) \
        .withColumn("at", F.explode(pairs)).select("fp", group, "at.x", "at.y")


def links(docs: DataFrame, rows: DataFrame, text: str, stages: Stages, block: int = BLOCK) -> DataFrame:
    """``a, b``: digests of linked sets, a spanning forest of all links.  ``rows``: see ``classes``."""
    spark = docs.sparkSession
    n = buckets(spark)
    met = stages.write(meetings(docs, text, n), "meetings")
    known = rows.where("digest is not null").groupBy("digest").agg(
        F.first("fp").alias("fp"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    groups = known.join(in_blocks(met, "center", block), "fp").select("center", "x", "y", "fp", "size", "sketch") \
        .repartition(n, "center", "x", "y").sortWithinPartitions("center", "x", "y")

    def narrow(batches):
        for _, members in runs_of_keys(batches, 3):
            if len(members) < 2:
                continue
            fps = np.array([m[0] for m in members])
            found = near_forest(np.array([m[1] for m in members]), [m[2] for m in members])
            name = np.arange(len(fps))
            for a, b in found:
                name[name == name[b]] = name[a]
            least = {k: int(fps[name == k].min()) for k in {int(name[a]) for a, _ in found}}
            if least:
                kept = [(f, least[k]) for f, k in zip(fps.tolist(), name.tolist()) if k in least]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept)], names=["fp", "least"])

    near = stages.write(groups.mapInArrow(narrow, "fp long, least long").distinct(), "near")
    stages.drop("meetings")
    bits = broadcast_bits(spark, bitmap_slices(near, "fp", 48, BITS), 2**BITS // 8)
    sets = active_sets(docs, text, bits)
    groups = sets.join(in_blocks(near, "least", block), "fp").select("least", "x", "y", "digest", "members") \
        .repartition(n, "least", "x", "y").sortWithinPartitions("least", "x", "y")

    def settle(batches):
        for _, members in runs_of_keys(rows_by_bytes(batches, "members"), 3):
            members = list(dict(members).items())
            if len(members) > 1:
                found = forest([np.sort(from_low_bytes(m, 6)) for _, m in members])
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([members[p[k]][0] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return groups.mapInArrow(settle, "a binary, b binary")


def similarity_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``.

    component_id: the smallest key reachable by links.  A null text or one without words has no set and
    its own key; a text of fewer than five words is one shingle; equal and repeated rows link with each
    other; a null key is never the smallest unless all are null; an empty table gives no rows.  Only the
    two named columns are read."""
    return _classed(docs, key, text, block).select("doc_id", "n_shingles", "component_id")


def _classed(docs: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """The columns of ``similarity_classes``, text_hash, and c: what stands for the class (null without a set)."""
    stages = Stages(docs.sparkSession, "jaccard")
    rows = stages.write(classes(docs, key, text), "classes")
    edges = stages.write(links(docs, rows, text, stages, block), "edges")
    comp = components(edges, stages)
    per = rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"))
    per = stages.write(per.join(comp, per["digest"] == comp["v"], "left").select("digest", "least", F.coalesce("c", "digest").alias("c")), "sets")
    least = per.groupBy("c").agg(F.min("least").alias("component_id"))
    named = per.join(least, "c").select(F.col("digest").alias("d"), "component_id", "c")
    return rows.join(named, rows["digest"] == named["d"], "left").select(
        "doc_id", "text_hash", "n_shingles", "c",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of each class of near duplicates (with doc_id, text): that of the smallest doc_id.

    Texts that share a doc_id but no class are classes of their own and all stay; within a class the row of
    the smallest text hash stands for an id that comes twice.  Rows without a doc_id cannot be named and stay."""
    told = _classed(docs, "doc_id", "text", block).where("doc_id = component_id")
    keep = told.groupBy(F.col("doc_id").alias("d"), F.coalesce("c", F.col("text_hash").cast("string").cast("binary")).alias("c")) \
        .agg(F.min("text_hash").alias("h")).select("d", "h")
    rows = boxed(docs, doc_id=F.col("doc_id"), text_hash=F.xxhash64("text"))
    named = rows.join(keep, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("h")), "left_semi") \
        .dropDuplicates(["doc_id", "text_hash"])
    return named.unionByName(rows.where("doc_id is null")).select("row.*")
