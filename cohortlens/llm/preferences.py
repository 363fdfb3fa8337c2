"""Preference formatting: pairs of conversations as one prompt and two masked completions.

DataFrame functions only; one shuffle brings the turns of a pair together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|{role}|>\n", "<|end|>\n"


def _head(turn: Column) -> Column:
    before, after = BEGIN.split("{role}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _spans(turns: Column, trained: str) -> Column:
    """``array<struct<start,stop>>`` in code points of a completion: what the trained role says, its end mark included."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def add(acc, t):
        start = acc["at"] + F.length(_head(t))
        stop = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(t["role"] == trained, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, begin, add)["spans"]


def format_pairs(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans`` from turns
    ``pair_id, chosen (boolean), turn, role, text``: one row per pair that has turns on both sides.

    The longest common prefix of (role, text) turns is the prompt, rendered once; the rest of each side
    is its completion, in which only ``trained`` turns count (spans); everything else is masked.  Turns
    go by turn, then role and text, so repeated turn numbers have an order and null numbers come first.
    A null role is ``unknown``, a null text empty.  Equal conversations have empty completions; a row
    without pair or side, and a pair with one side only, give no row; an empty table gives none."""
    rows = turns.where("pair_id is not null and chosen is not null").select(
        "pair_id", "chosen", F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                                      F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    side = lambda flag: F.sort_array(F.collect_list(F.when(F.col("chosen") == flag, F.col("t"))))
    strip = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    pairs = rows.groupBy("pair_id").agg(side(True).alias("c"), side(False).alias("r")).where("size(c) > 0 and size(r) > 0") \
        .select("pair_id", strip(F.col("c")).alias("c"), strip(F.col("r")).alias("r"))
    return _formatted(pairs, trained)


def _formatted(pairs: DataFrame, trained: str) -> DataFrame:
    """The columns of ``format_pairs`` from ``pair_id, c, r``: the turns (role, text) of both sides in order."""
    both = F.least(F.size("c"), F.size("r"))
    differs = F.transform(F.sequence(F.lit(1), both), lambda i: F.element_at("c", i) != F.element_at("r", i))
    first = F.array_position(differs, F.lit(True))
    pairs = pairs.withColumn("n_common", F.when(first > 0, first - 1).otherwise(both).cast("int"))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.size(c))
    pairs = pairs.withColumns({"prompt": _render(F.slice("c", 1, F.col("n_common"))), "c": rest(F.col("c")), "r": rest(F.col("r"))})
    return pairs.select("pair_id", "n_common", "prompt", _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
                        _spans(F.col("c"), trained).alias("chosen_spans"), _spans(F.col("r"), trained).alias("rejected_spans"))


def last_turn_pairs(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """The columns of ``format_pairs`` for each conversation (conv_id, turn, role, text), pair_id its conv_id.

    Chosen is the whole conversation, rejected the same with its last ``trained`` turn said as in the next
    conversation that has one, of the same 1,024 conv_ids (after the last the first; empty if there is no
    other).  Without a ``trained`` turn both sides are the conversation: all prompt, empty completions.
    Turns go in the order of ``format_pairs``; rows without a conv_id give no row."""
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    lasts = turns.where(F.col("t")["role"] == trained).groupBy("conv_id").agg(F.max("t").alias("t")) \
        .select("conv_id", F.shiftright("conv_id", 10).alias("bucket"), F.col("t")["text"].alias("said"))
    order = Window.partitionBy("bucket").orderBy("conv_id")
    after = F.when(F.first("conv_id").over(order) != F.col("conv_id"), F.first("said").over(order))
    other = lasts.select(F.col("conv_id").alias("o"), F.coalesce(F.lead("said").over(order), after, F.lit("")).alias("other"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("s"))
    whole = whole.join(other, F.col("conv_id") == F.col("o"), "left").select(
        F.col("conv_id").alias("pair_id"), "other", F.transform("s", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("c"))
    back = F.array_position(F.reverse(F.transform("c", lambda t: t["role"])), trained)
    whole = whole.withColumn("last", F.when(back > 0, F.size("c") - back))
    said = F.transform("c", lambda t, i: F.when(i == F.col("last"), F.struct(t["role"].alias("role"), F.col("other").alias("text"))).otherwise(t))
    return _formatted(whole.select("pair_id", "c", said.alias("r")), trained)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
