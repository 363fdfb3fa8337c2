"""Language identification: held-out accuracy, kernels against brute force, awkward texts."""

import zlib

import numpy as np
import pytest

from cohortlens.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1 for i in want)
    held = [got[i].lang_pred == want[i] for i in want if got[i].held_out and want[i] is not None]
    assert len(held) > 20 and np.mean(held) > 0.95


def test_awkward_documents(docs, rows, no_docs):
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (80, 81, 82, 86)} == {"und"} and by[80].score == 0
    assert by[83].lang_pred == "en" and by[85].lang_pred == "en"
    assert language.identify(no_docs).count() == 0


def test_a_language_of_long_texts_alone_is_learned(spark):
    from pyspark.sql import functions as F

    rnd = __import__("random").Random(2)
    say = lambda letters, n: " ".join("".join(rnd.choices(letters, k=5)) for _ in range(n))
    rows = [(i, say("abcdef", 40), "short") for i in range(12)] + [(20 + i, say("uvwxyz", 5000), "long") for i in range(3)] \
        + [(30, say("abcdef", 9000), "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = language.training_sample(df, F.lit(True), "text", "lang", per_language=12)
    assert {r["lang"] for r in chosen} == {"short", "long"} and sum(r["lang"] == "short" for r in chosen) == 12
    assert all(len(r["text"]) < 1000 for r in chosen if r["lang"] == "short")  # longer ones come after all shorter ones
    (one,) = language.training_sample(df.where("lang = 'long'"), F.lit(True), "text", "lang", per_language=1)
    assert len(one["text"]) > language.LONGEST_FITTED
    assert {r.lang_pred for r in language.identify(df).where("doc_id between 20 and 22").collect()} == {"long"}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(i, "some text", None) for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify(df).collect()} == {"und"}


def test_scores_are_kernels_with_landmarks():
    texts = ["the cat sat", "der hund lief", "the dog ran", "die katze sass", "a cat", "ein hund"]
    langs = ["en", "de", "en", "de", "en", "de"]
    model = language.fit(texts, langs, landmarks=2)
    sets = [set(language.grams(t).tolist()) for t in texts]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    marks = [1, 3, 0, 2]  # by language, then place
    small = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in marks])
    values, vectors = np.linalg.eigh(small)
    root = vectors / np.sqrt(values)
    features = np.array([[kernel(s, sets[j]) for j in marks] for s in sets]) @ root
    y = np.array([[1 if x == k else -1 for k in ("de", "en")] for x in langs])
    w = np.linalg.solve(features.T @ features / 3 + language.RIDGE * np.eye(4), features.T @ y / 3)
    assert np.allclose(model.margins([language.grams(t) for t in texts]), features @ w, atol=1e-4)


@pytest.mark.parametrize("text,n", [("", 0), ("ab", 3), ("aaaa", 4), ("a  b", 6)])
def test_grams(text, n):
    assert len(language.grams(text)) == n
