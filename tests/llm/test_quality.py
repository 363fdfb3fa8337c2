"""Quality rules against a plain Python version."""

import collections
import re

from cohortlens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, max_docs=quality.MAX_DOCS, min_left=quality.MIN_LEFT):
    def lines(t):
        return [x for x in (" ".join(WORD.findall(line.lower())) for line in (t or "").split("\n")) if x]

    texts, first = collections.defaultdict(set), {}
    for i, t, _, s, *_ in rows:
        for x in lines(t):
            texts[s, x].add((i, t))
            if i is not None:
                first[s, x] = min(i, first.get((s, x), i))
    out = []
    for i, t, _, s, *_ in rows:
        w = WORD.findall(t or "")
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        repeat = {j + d for j in range(len(w) - 2) if seen[w[j], w[j + 1], w[j + 2]] > 1 for d in range(3)}
        own = [x for x in (t or "").split("\n") if WORD.search(x)]
        gone = sum(len(x.split(" ")) for x in lines(t) if len(texts[s, x]) > max_docs and first.get((s, x)) != i)
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(own) - len(set(own)), len(repeat),
                    failed, gone, not failed and len(w) - gone >= min_left * len(w)))
    return out


def test_judge_equals_brute_force(docs, rows):
    got = quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "n_removed_words", "kept").collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r[7] for r in want) and any(r[8] for r in want)


def test_depleted_documents_go_and_the_first_stays(spark):
    body = "\n".join(f"line {k} " + "word " * 12 for k in range(6))
    rows = [(i, body + f"\nown {i}", "s", None) for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")
    kept = {r.doc_id for r in quality.judge(df).where("kept").collect()}
    assert kept == set()  # every window repeats: the base rule fails all
    rows = [(i, "\n".join(" ".join(f"w{k}_{j}" for j in range(12)) for k in range(6)) + f"\nown {i}", "s", None) for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")
    assert {r.doc_id for r in quality.judge(df).where("kept").collect()} == {0}
    assert quality.judge(df, max_docs=20).where("kept").count() == 15
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df).count() == 1


def brute_texts(rows, max_docs=quality.MAX_DOCS):
    """Kept rows in full, lines above the limit taken out of all but the host's first document."""
    def norm(line):
        return " ".join(WORD.findall(line.lower()))

    texts, first = collections.defaultdict(set), {}
    for i, t, _, s, *_ in rows:
        for x in {norm(line) for line in (t or "").split("\n")} - {""}:
            texts[s, x].add((i, t))
            if i is not None:
                first[s, x] = min(i, first.get((s, x), i))
    out = []
    for r, verdict in zip(rows, brute(rows, max_docs)):
        if verdict[8]:
            i, t, lang, s, n, *more = r
            left = "\n".join(x for x in t.split("\n") if len(texts[s, norm(x)]) <= max_docs or first.get((s, norm(x))) == i)
            out.append((i, left, lang, s, n if left == t else len(left), *more))
    return out


def test_kept_texts_lose_the_lines_above_the_limit(docs, rows):
    got, want = quality.keep_good(docs), brute_texts(rows)
    assert got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len({r[1] for r in want} - {r[1] for r in rows}) == 13  # of 14 documents with the line the first keeps it


def test_exact_copies_count_as_documents(spark, rows):
    text = rows[0][1] + "\nown"
    copies = [(i, text, "s") for i in range(11)] + [(i, text, "few") for i in range(20, 30)] + [(40, text, "same")] * 11
    df = spark.createDataFrame(copies, "doc_id long, text string, source string")
    kept = sorted(r.doc_id for r in quality.judge(df).collect() if r.kept)
    assert kept == [0, *range(20, 30), *[40] * 11]  # 11 copies: the first stays; 10 copies, or one row 11 times: all


def test_verdict_can_be_filtered(spark):
    rows = [(0, "same " * 5000, "s"), (1, " ".join(f"w{i}" for i in range(5000)), "s"), (2, None, "s")]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert [r.doc_id for r in judged.where("kept").collect()] == [1]
    assert judged.where("base_failed and n_words > 10 and n_repeat_words = 5000").count() == 1


def test_empty_table(no_docs):
    assert quality.judge(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0
