"""Filter interaction audit by forward-backward path counting on the subset lattice.

A state is the set of filters applied so far; an edge adds one filter to it and removes the
documents that fail this filter and none of the state.  Orders of application are the paths
from the empty state to the full one.  Counting the paths that reach a state forwards and
those that leave one backwards gives the number of orders through each edge, so a filter's
total over all orders (its Shapley value times their number) is a weighted sum over its
edges, and the figures of any order are those of the edges along its path.

The corpus is read once: each document gives the set of filters it fails, and documents are
counted by part and set, with map-side partial counts.  The lattice then works on at most 2**k
counts per part, in columns; nothing is collected and no order is replayed on documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import Stages, rows_by_bytes, schema_of

MOST_FILTERS = 6  # 720 orders and 64 states a part
COUNTS = ("n", "good", "toxic")

# FIXED VALUES: the five production filters fail a text with
MIN_WORDS = 200                              # A: fewer words
MIN_DISTINCT_PERCENT = 50                    # B: fewer distinct words, of all its words
MAX_UPPER_PERCENT = 3                        # C: more letters A-Z, of its code points
SYMBOLS = re.compile(r"[#$%&*|]")            # D: any of these
#                                              E: the text of a smaller doc_id
FILTERS = "ABCDE"


def lattice(k: int) -> list[tuple[int, int, int]]:
    """``(state, filter, orders)`` of every edge of the lattice of ``k`` filters; orders: paths through it."""
    full = (1 << k) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for s in range(1, full + 1):
        reach[s] = sum(reach[s ^ (1 << f)] for f in range(k) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | 1 << f] for f in range(k) if not s >> f & 1)
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(full) for f in range(k) if not s >> f & 1]


def paths(names: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """``(filter_order, step, state, filter)`` along every order of the filters."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[g] for g in order), step, state, f))
            state |= 1 << f
    return out


def audit(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Figures of every part, order and step from ``part, fails, n, good, toxic``: how many documents of a part
    fail the filters whose bits (that of ``names[0]`` is 1) are set in ``fails``, how many of those are good, toxic.

    Returns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``:
    all orders and steps of every part that has a row, zeros included.  Cells may come in any number of rows."""
    k = len(names)
    if not 1 <= k <= MOST_FILTERS or len(set(names)) < k:
        raise ValueError(f"1 to {MOST_FILTERS} filters with names of their own, not {list(names)}")
    spark = cells.sparkSession
    cells = cells.groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in COUNTS])
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", *COUNTS)).alias("cells"))  # 2**k at most

    def total(which, name: str) -> Column:
        return F.aggregate(F.filter("cells", which), F.lit(0).cast("long"), lambda a, c: a + c[name])

    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"),
                              F.lit(w).cast("long").alias("orders"))
                      for s, f, w in lattice(k)])
    rows = parts.select("part", "cells", F.explode(edges).alias("e")).select("part", "cells", "e.*")
    bit = F.col("bit")
    here = lambda c: (c["fails"].bitwiseAND(F.col("state")) == 0) & (c["fails"].bitwiseAND(bit) != 0)
    rows = rows.select(
        "part", "state", "filter", "orders",
        total(lambda c: c["fails"].bitwiseAND(F.col("state").bitwiseOR(bit)) == 0, "n").alias("kept"),
        total(here, "n").alias("removed"), total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
        total(lambda c: c["fails"].bitwiseAND(bit) != 0, "n").alias("failing"),
        total(lambda c: c["fails"] == bit, "n").alias("unique_fails"))
    # a filter's edges, weighted by the orders that take them: one array of k sums a part
    weighted = rows.groupBy("part").agg(F.collect_list(F.struct("state", "filter", "orders", "kept", "removed", "good_lost", "toxic_lost",
                                                                "failing", "unique_fails")).alias("edges"))
    shapley = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.aggregate(
        F.filter("edges", lambda e: e["filter"] == f), F.lit(0).cast("long"), lambda a, e: a + e["orders"] * e["removed"]))
    rows = weighted.select("part", "edges", shapley.alias("totals")) \
        .select("part", "totals", F.explode("edges").alias("e")).select("part", "totals", "e.*")
    steps = spark.createDataFrame(paths(names), "filter_order string, step int, state int, filter int")
    return rows.join(F.broadcast(steps), ["state", "filter"]).select(  # k * k! rows
        "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", F.get("totals", F.col("filter")).alias("shapley"))


def failures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``fails`` (bits of filters A to D) and ``digest`` (SHA-256 of the text)."""
    keep = [c for c in docs.columns if c != text]
    schema = schema_of(docs.select(*keep), fails="int", digest="binary")
    capitals = dict.fromkeys(range(ord("A"), ord("Z") + 1))

    def run(batches):
        for b in rows_by_bytes(batches, text):
            fails, digests = [], []
            for t in b.column(b.schema.get_field_index(text)).to_pylist():
                t = t or ""
                data = t.encode()
                words = data.split()  # bytes are split at exactly \x20 and \x09-\x0D
                upper = len(t) - len(t.translate(capitals)) if not t.islower() else 0
                fails.append((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
                             | (100 * upper > MAX_UPPER_PERCENT * len(t)) << 2 | (SYMBOLS.search(t) is not None) << 3)
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep),
                                              pa.array(fails, pa.int32()), pa.array(digests, pa.binary())], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)


def document_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, fails, n, good, toxic`` of the five production filters, for ``audit``.

    Every row of ``docs`` is a document (repeated rows too).  A null text is empty, a null part the empty
    string; a null key is neither larger nor smaller than another and has no label.  ``labels`` (doc_id,
    quality, toxic) may cover some documents, and lack or repeat them: a document is good (toxic) if any of
    its labels says 1.  Other columns are not read; an empty table gives no rows.

    Texts are read once.  What follows are rows of a digest and numbers: equal ones are counted before they
    are shuffled, so copies of a text or of a row make no hot key; the first of each text is found by a join
    on digest and key, which spreads the copies of one text."""
    stages = Stages(docs.sparkSession, "audit")
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))
    slim = stages.write(failures(rows).groupBy("doc_id", "part", "fails", "digest").agg(F.count(F.lit(1)).alias("n")), "fails")
    first = slim.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("f")) \
        .select(F.col("digest").alias("d"), "f", F.lit(True).alias("is_first"))
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = slim.join(first, (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("f")), "left") \
        .join(told, F.col("doc_id") == F.col("l"), "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    flags = {"good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))}
    return rows.select("part", F.col("fails").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("fails"), "n",
                       *[F.when(c, F.col("n")).otherwise(0).alias(k) for k, c in flags.items()]) \
        .groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in COUNTS])


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of ``audit`` for the five production filters on documents, by lang."""
    return audit(document_cells(docs, labels), FILTERS)


def flagged_cells(rows: DataFrame, filters: Sequence[str], part: str, good: Column, toxic: Column) -> DataFrame:
    """``part, fails, n, good, toxic`` from boolean columns ``filters`` (true: the row fails) of any table;
    null flags are false."""
    bits = [F.when(F.col(c), 1 << i).otherwise(0) for i, c in enumerate(filters)]
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    return rows.select(F.col(part).alias("part"), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fails"),
                       one(good).alias("good"), one(toxic).alias("toxic")) \
        .groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
