"""Mixing sources to target weights by cube-method balanced sampling.

Each source's target words give an expected number of copies per document, f <= cap.  All
documents get floor(f) copies; the fraction is an inclusion probability, the same within a
source.  The flight phase moves the probabilities of three documents at a time along the null
space of the two balancing constraints (sum of words, number of documents) until one of them
is 0 or 1, so both totals stay exactly as expected.  Blocks of bounded size fly apart; the at
most two undecided documents of each block fly again in the next level, until one block per
source is left, whose landing first gives up the document total, then rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import Stages, boxed, n_words

BLOCK = 4096
EPS = 1e-9


def targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[float, ...] = (1, 2, 3), budget: float = 1.0) -> DataFrame:
    """``source, rank, source_size, n, target``: one row per source (bounded by the number of sources).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``budget`` times all
    words; a target above ``cap`` times its source is cut to that and the excess shared anew by weight
    among the rest.  The water-filling level is found in closed form: with sources in the order of
    cap/weight, the first k are cut, k the largest number for which each is above its share."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # one row per source from here on; windows without a key see only these rows
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(order)).withColumn("weight", w) \
             .withColumn("most", cap * F.col("source_size"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(budget))
    rest = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", rest / weight)
    cut = F.col("most") <= F.col("level") * F.col("weight")
    per = per.withColumn("cut", cut).withColumn("line", F.min(F.when(~F.col("cut"), F.struct(F.col("most") / F.col("weight"), "rank", "level"))).over(Window.partitionBy()))
    return per.select("source", "rank", "source_size", "n",
                      F.when(F.col("cut"), F.col("most")).otherwise(F.col("line.level") * F.col("weight")).alias("target"))


def fly(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Flight phase of the cube method with the constraints sum(size * p) and sum(p); at most two
    entries stay undecided.  Entries may begin with different probabilities."""
    p = p.copy()
    hand: list[int] = []
    for i in np.flatnonzero((p > EPS) & (p < 1 - EPS)).tolist():
        hand.append(i)
        if len(hand) < 3:
            continue
        a, b, c = hand
        u = (float(size[b] - size[c]), float(size[c] - size[a]), float(size[a] - size[b]))  # sum(u) = sum(u * size) = 0
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        x = (p[a], p[b], p[c])
        up = min(((1 - x[k]) if u[k] > 0 else -x[k]) / u[k] for k in range(3) if u[k])
        down = min((x[k] if u[k] > 0 else -(1 - x[k])) / u[k] for k in range(3) if u[k])
        # a martingale: forward with probability down / (up + down); the draw is fixed by place and sizes
        step = up if _draw(i, x, u) * (up + down) < down else -down
        for k, j in enumerate(hand):
            v = x[k] + step * u[k]
            p[j] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
        hand = [j for j in hand if EPS < p[j] < 1 - EPS]
    return p


def _draw(i: int, x, u) -> float:
    return np.random.default_rng([i, int(x[0] * 2**40), int(x[1] * 2**40), int(abs(u[0])), int(abs(u[1]))]).random()


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Decides the last documents of a source: two of them keep the words' total alone, the last is
    rounded; what that leaves of the total is mended by turning documents of this last block round,
    each time the one that brings the total nearest."""
    p, wanted = p.copy(), float(size @ p)
    while len(i := np.flatnonzero((p > EPS) & (p < 1 - EPS))) >= 2:
        a, b = i[:2]
        u = (float(size[b]), -float(size[a])) if size[a] or size[b] else (1.0, -1.0)
        up = min(((1 - p[k]) if v > 0 else -p[k]) / v for k, v in ((a, u[0]), (b, u[1])) if v)
        down = min((p[k] if v > 0 else p[k] - 1) / v for k, v in ((a, u[0]), (b, u[1])) if v)
        step = up if _draw(int(a), (p[a], p[b]), u) * (up + down) < down else -down
        for k, v in ((a, u[0]), (b, u[1])):
            w = p[k] + step * v
            p[k] = 0.0 if w < EPS else 1.0 if w > 1 - EPS else w
    for k in i:
        if EPS < p[k] < 1 - EPS:
            p[k] = float(p[k] >= 0.5)
    over = float(size @ p) - wanted
    while len(p):
        turned = size * (1 - 2 * p)
        k = int(np.argmin(np.abs(over + turned)))
        if abs(over + turned[k]) > abs(over) - 0.5:
            return p
        over += turned[k]
        p[k] = 1 - p[k]
    return p


def landed(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Flight and landing; documents whose probability is 0 or 1 from the start stay as they are."""
    out, open_ = p.copy(), (p > EPS) & (p < 1 - EPS)
    flown = fly(size[open_], p[open_])
    out[open_] = land(size[open_].astype(float), flown)
    return out


def sample_copies(sizes: DataFrame, plan: DataFrame, stages: Stages, block: int = BLOCK) -> DataFrame:
    """``sizes`` (doc_id, source, size) with ``copies``, ``source_size`` and ``target``.

    ``plan``: see ``targets``.  Blocks come from a hash of doc_id and size, so reruns agree; fully equal
    rows are interchangeable."""
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    f = F.when(F.abs(f - F.round(f)) < 1e-9, F.round(f)).otherwise(f)
    docs = sizes.join(F.broadcast(plan.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    docs = docs.withColumn("f", f).withColumn("whole", F.floor("f").cast("long")) \
        .withColumn("p", F.col("f") - F.floor("f")).withColumn("h", F.xxhash64(F.lit(9), "doc_id", "size"))
    docs = stages.write(docs.withColumn("b", F.pmod("h", F.ceil(F.col("n") / block))).drop("f"), "docs")
    most = docs.agg(F.max("b")).first()[0]
    if most is None:
        return docs.withColumn("copies", F.col("whole"))
    schema = docs.schema
    decided, undecided, level = None, docs, 0

    def flight(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            # large documents first: the few that stay undecided are small, which keeps the landing near
            pdf = pdf.sort_values(["size", "h", "doc_id", "p"], ascending=[False, True, True, True], ignore_index=True, kind="stable")
            size, p = pdf["size"].to_numpy(), pdf["p"].to_numpy()
            return pdf.assign(p=landed(size, p) if last else fly(size, p))
        return run

    while True:
        last = most == 0
        flown = stages.write(undecided.groupBy("rank", "b").applyInPandas(flight(last), schema), f"flight-{level}")
        done = flown.where((F.col("p") == 0) | (F.col("p") == 1))
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        # two of each block are left: a quarter as many blocks as would hold them keeps blocks bounded
        most = most * 2 // block
        undecided = flown.where((F.col("p") > 0) & (F.col("p") < 1)).withColumn("b", F.pmod(F.xxhash64("b"), F.lit(most + 1)))
        level += 1
    return decided.withColumn("copies", F.col("whole") + F.col("p").cast("long"))


def sizes_of(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", cap: float = 3.0,
        weights: tuple[float, ...] = (1, 2, 3), block: int = BLOCK) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: one row per row of ``docs``.

    Null texts and texts without words have size 0; they carry no words but count as documents.  A
    null source is a source of its own; null and repeated keys are documents like any other; an
    empty table gives no rows.  Only the three named columns are read, so others cannot clash.
    A source without words gets target 0 and no copies."""
    stages = Stages(docs.sparkSession, "mix")
    sizes = stages.write(sizes_of(docs, key, source, text), "sizes")
    plan = stages.write(targets(sizes, cap, weights), "targets")
    return sample_copies(sizes, plan, stages, block).select("doc_id", "source", "size", "source_size", "target", "copies")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (with doc_id, source, text), each as often as the mix takes it."""
    made = mix(docs, **options).groupBy("doc_id", "source", "size").agg(F.sort_array(F.collect_list("copies"), False).alias("copies"))
    made = made.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), "copies")
    rows = boxed(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=n_words(F.col("text")), h=F.xxhash64("text"))
    rows = rows.join(made, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    one = rows.where(F.size("copies") == 1).select("row", F.col("copies")[0].alias("times"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("h"))
    many = rows.where(F.size("copies") > 1).withColumn("r", rank).select("row", F.element_at("copies", F.col("r")).alias("times"))
    return one.unionByName(many).where("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")
