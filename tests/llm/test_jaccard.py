"""N-gram Jaccard join against brute force, and the guarantee of its signatures."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(t):
    w = WORD.findall((t or "").translate(FOLD))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    return [(r[0], len(s), least.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group)]


def test_classes_equal_brute_force(docs, rows):
    want = brute(rows)
    assert len({w[2] for w in want}) < len(want) - 10
    for block in (jaccard.BLOCK, 3):  # groups in one piece, and in pairs of blocks
        got = [tuple(r) for r in jaccard.similarity_classes(docs, block=block).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_chains_short_texts_and_case(spark):
    rnd = random.Random(3)
    t = [f"w{rnd.randrange(10**6)}" for _ in range(90)]
    rows = []
    for i in range(12):  # each links with the next, not with all
        t[(7 * i) % 90] = f"n{i}"
        rows.append((100 - i, " ".join(t)))
    rows += [(200, "a b c d e"), (201, "A B  C\tD E"), (202, "a b c d"), (203, "A b C d"), (204, "a b c d e f"), (205, "x"), (206, "X")]
    got = [tuple(r) for r in jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute(rows))


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.floats(0, 1))
def test_linked_sets_share_a_signature(n, seed, share):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
    drop = int(len(a) * 0.2 * share)  # removed from a, and as many as the threshold allows added
    kept = a[drop:]
    add = int(max(0, len(kept) / 0.8 - len(a)))
    b = np.unique(np.concatenate([kept, rng.integers(0, 2**63, add, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
    common = len(np.intersect1d(a, b))
    enum = jaccard.PartEnum()
    if jaccard.linked(len(a), len(b), common) and len(np.setxor1d(a, b)):
        assert set(enum.of(a).tolist()) & set(enum.of(b).tolist())
        assert jaccard.near_forest(np.array([len(a), len(b)]), [jaccard.sketch(a), jaccard.sketch(b)]) == [(0, 1)]


def test_forest_connects_as_all_pairs_do():
    rng = np.random.default_rng(4)
    pool = [np.unique(rng.integers(0, 300, 60).astype(np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([rng.choice(p, 45, replace=True), p[:40]])) for p in pool for _ in range(8)]
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if jaccard.linked(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j]))):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    mine = list(range(len(sets)))
    for x, y in jaccard.forest(sets):
        a, b = mine[x], mine[y]
        assert a != b  # no link too many
        mine = [b if g == a else g for g in mine]
    same = lambda g: sorted(collections.Counter(g).values())
    assert same(mine) == same(group)


def test_keep_first_and_empty_table(spark, docs, rows, no_docs):
    kept = [r.doc_id for r in jaccard.keep_first(docs).select("doc_id").collect()]
    want = {r[0] for r in brute(rows) if r[0] is not None and r[0] == r[2]}
    assert sorted(i for i in kept if i is not None) == sorted(want) and kept.count(None) == 2
    assert jaccard.similarity_classes(no_docs).count() == 0


def test_keep_first_keeps_every_class_of_one_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a, "x"), (1, b, "y"), (1, b, "y"), (2, a, "z"), (3, "", None), (3, " ", None), (3, None, None), (1, a + " more", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.text) for r in jaccard.keep_first(df).collect()]
    assert len(got) == 5 and {(1, b), (3, ""), (3, " "), (3, None)} < set(got)
    assert sum(t in (a, a + " more") for _, t in got) == 1  # one class, one id: one row


def test_a_task_holds_little_beside_its_batch():
    """One batch of 10 MB: the arrays made of its texts are few at any time, and the sets are those of single texts."""
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(700)}" for _ in range(1000)) for _ in range(2000)]
    batch = pa.record_batch({"text": texts})
    n = 0
    tracemalloc.start()
    for b, sets in jaccard.text_sets([batch]):
        n += sum(map(len, sets))
        assert len(sets) == b.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 9_000_000 and n == sum(len(shingle_set(t)) for t in texts)
    assert peak < 40_000_000  # 16 MB here; 64 MB with a megabyte of text at once


def test_sets_meet_at_the_smallest_in_bounded_pieces():
    rng = np.random.default_rng(6)
    buckets, groups = {}, collections.defaultdict(set)
    for bucket, n in ((0, 40), (3, 600_000), (4, 1)):  # the second takes several pieces
        s, f = rng.integers(0, 5 * n, n).astype(np.uint64), rng.integers(1, 2**40, n).astype(np.uint64)
        s, f = np.concatenate([s, s[:n // 9]]), np.concatenate([f, f[:n // 9]])  # some rows twice
        buckets[bucket] = [(bucket, jaccard.low_bytes(s[i:i + 7000], 5), jaccard.low_bytes(f[i:i + 7000], 6)) for i in range(0, len(s), 7000)]
        for x, y in zip(s.tolist(), f.tolist()):
            groups[bucket, x].add(y)
    want = {(y, min(g)) for g in groups.values() if len(g) > 1 for y in g}
    del groups
    batch = pa.record_batch(list(map(list, zip(*(r for rows in buckets.values() for r in rows)))), schema=pa.schema(
        [("bucket", pa.int32()), ("sigs", pa.binary()), ("fps", pa.binary())]))
    del buckets
    tracemalloc.start()
    out = [(b.column("fp").to_numpy(), b.column("center").to_numpy()) for b in jaccard.meet(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {p for fp, center in out for p in zip(fp.tolist(), center.tolist())} == want and len(want) > 50_000
    assert len(out) > 4 and peak < 36_000_000  # 24 MB; 46 MB with the bucket sorted as a whole
