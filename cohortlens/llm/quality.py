"""Quality rules: base measures of each text and cross-document line frequency.

DataFrame functions only.  Normalised lines are hashed; for each host and line the distinct
documents that hold it are counted, exact copies each on their own; a line in more than
``max_docs`` of them is removed from all but the host's smallest doc_id that has it; a document
left with less than ``min_left`` of its words is rejected.  ``judge`` shuffles only hashes and counts, partially aggregated, never texts;
``keep_good`` gives the rows back without the removed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import Stages, boxed

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 10
MIN_LEFT = 0.3


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (null text: all 0).

    Repeated three-word windows are found by sorting each text's window hashes (64 bits)."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACES), lambda w: w != "")
    with_word = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    out = docs.withColumns({
        "_words": F.transform(words, lambda w: F.xxhash64(w)), "_lines": with_word,
        "word_chars": F.length(F.translate(t, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(F.size("_words") > 2, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))),
    })
    out = out.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_sorted", lambda x, j: x["h"].eqNullSafe(F.get("_sorted", j - 1)["h"])
                     | x["h"].eqNullSafe(F.get("_sorted", j + 1)["h"]))
    out = out.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("_at", lambda x, j: F.coalesce(F.least(F.get("_at", j + 1) - x, F.lit(3)), F.lit(3))),
                          F.lit(0), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")) \
        .drop("_words", "_lines", "_windows", "_sorted", "_at")


def normalised(line: Column) -> Column:
    """Lower case, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), SPACES, " "))


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, host, digest, at, line, words`` of every line with a word; line: hash of the normalised line."""
    lines = docs.select("doc_id", "host", F.xxhash64("text").alias("digest"),
                        F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    lines = lines.withColumn("raw", normalised(F.col("raw"))).where("raw <> ''")
    return lines.select("doc_id", "host", "digest", "at", F.xxhash64("raw").alias("line"),
                        (F.length("raw") - F.length(F.translate("raw", " ", "")) + 1).cast("long").alias("words"))


def common_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """``host, line, n_docs, first_doc``: lines in more than ``max_docs`` documents of a host.

    Copies under other ids are documents of their own; only fully repeated rows are one."""
    per_doc = lines.select("host", "line", "doc_id", "digest").distinct()
    per_line = per_doc.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return per_line.where(F.col("n_docs") > max_docs)


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
          max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """``doc_id, digest, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_words, kept``: one row per row of ``docs``.

    A null or empty text has no words and fails the base rule.  A null host is a host of its own; rows
    with a null key are judged by their text; fully repeated rows count once and get the same verdict;
    an empty table gives no rows.  Only the three named columns are read."""
    return _judged(docs, key, host, text, max_docs, min_left).drop("removed_at")


def _judged(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
            max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The columns of ``judge`` and removed_at: which lines of the text (from 0) go, null if none."""
    stages = Stages(docs.sparkSession, "quality")
    docs = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    lines = stages.write(document_lines(docs), "lines")
    common = common_lines(lines, max_docs)
    common = common.select(F.col("host").alias("h"), F.col("line").alias("l"), "first_doc")
    hit = lines.join(common, lines["host"].eqNullSafe(common["h"]) & (lines["line"] == common["l"])) \
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    removed = hit.dropDuplicates(["doc_id", "host", "digest", "at"]) \
        .groupBy(F.col("doc_id").alias("d"), F.col("host").alias("h"), F.col("digest").alias("g")) \
        .agg(F.sum("words").alias("n_removed_words"), F.collect_list("at").alias("removed_at"))
    # staged: a filter on the verdict then reads numbers instead of computing every measure again inside it
    base = stages.write(base_measures(docs.withColumn("digest", F.xxhash64("text"))).drop("text"), "base")
    out = base.join(removed, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("host").eqNullSafe(F.col("h"))
                    & (F.col("digest") == F.col("g")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    gone = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    return out.select("doc_id", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), gone.alias("n_removed_words"),
                      (~failed & (F.col("n_words") - gone >= F.lit(min_left) * F.col("n_words"))).alias("kept"), "removed_at")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (with doc_id, source, text) that ``judge`` keeps, their texts without the lines
    above the limit; n_chars, if there, follows a text that lost lines, all other columns are as they are."""
    told = _judged(docs, **options).where("not kept or removed_at is not null").select(
        F.col("doc_id").alias("d"), F.col("host").alias("h"), F.col("digest").alias("g"), "kept", "removed_at").dropDuplicates(["d", "h", "g"])
    rows = boxed(docs, doc_id=F.col("doc_id"), host=F.col("source"), digest=F.xxhash64("text"))
    rows = rows.join(told, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("host").eqNullSafe(F.col("h"))
                     & (F.col("digest") == F.col("g")), "left").where(F.coalesce("kept", F.lit(True)))
    left = F.transform(F.array(F.split(F.col("row")["text"], "\n")), lambda lines: F.array_join(F.transform(  # split once
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed_at")), lambda i: F.get(lines, i)), "\n"))
    rows = rows.withColumn("left", F.when(F.col("removed_at").isNotNull(), left[0]))
    new = {"text": F.col("left"), "n_chars": F.length("left")}
    return rows.select(*[(F.when(F.col("left").isNotNull(), new[f.name].cast(f.dataType)).otherwise(F.col("row")[f.name]) if f.name in new
                          else F.col("row")[f.name]).alias(f.name) for f in docs.schema])
