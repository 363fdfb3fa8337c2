"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the distinct n-grams (1 to 4 characters)
that both hold, divided by the root of the product of their numbers.  Nyström features come from
landmark texts; one-versus-rest ridge regression is fitted on them in closed form.  The kernel with
the landmarks is a product of presence rows, so a batch's scores are one product of its presence
matrix (sparse, over the landmarks' n-grams) with a matrix of n-grams by languages.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import mix, rows_by_bytes, schema_of

GRAMS = 4
PER_LANGUAGE = 300      # texts a language that are fitted on; a bound, whatever the input
LANDMARKS = 64          # of those, a language
LONGEST_FITTED = 20_000  # characters; longer texts are classified whole, and fitted on only where shorter ones are too few
RIDGE = 1e-3
UNKNOWN = "und"
U = np.uint64
LETTER = re.compile(r"[^\W\d_]")
SPACE = re.compile(r"\s+")


def grams(text: str, longest: int = GRAMS) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text: lower case, white space runs as one space."""
    c = np.frombuffer(SPACE.sub(" ", text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(1)
    out, h = [], np.zeros(len(c), U)
    for n in range(1, min(longest, len(c)) + 1):
        # up to four code points of 21 bits: exact up to three, mixed beyond
        h = h[:len(c) - n + 1] * U(0x2545F4914F6CDD1D) + c[n - 1:]
        out.append(mix(h + U(n)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U)


class Model:
    """``languages``, sorted ``vocabulary`` of n-gram hashes, ``weights`` (n-grams by languages)."""

    def __init__(self, languages: list[str], vocabulary: np.ndarray, weights: np.ndarray):
        self.languages, self.vocabulary, self.weights = languages, vocabulary, weights

    def margins(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of a batch of presence rows: (rows x n-grams) times (n-grams x languages)."""
        sizes = np.array([len(t) for t in texts])
        flat = np.concatenate(texts) if texts else np.zeros(0, U)
        at = np.minimum(np.searchsorted(self.vocabulary, flat), len(self.vocabulary) - 1)
        w = self.weights[at] * (self.vocabulary[at] == flat)[:, None]
        out = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        if len(full):
            out[full] = np.add.reduceat(w, starts, axis=0) / np.sqrt(sizes[full])[:, None]
        return out


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Kernel ridge regression with Nyström landmarks: the first ``landmarks`` texts of each language."""
    rows = [grams(t) for t in texts]
    keep = [i for i, r in enumerate(rows) if len(r)]
    names = sorted({languages[i] for i in keep})
    if not names:
        return None
    rows, y = [rows[i] for i in keep], np.array([names.index(languages[i]) for i in keep])
    marks = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(names))])
    vocabulary = np.unique(np.concatenate([rows[i] for i in marks]))
    presence = np.zeros((len(vocabulary), len(marks)), np.float32)
    for j, i in enumerate(marks.tolist()):
        presence[np.searchsorted(vocabulary, rows[i]), j] = 1 / np.sqrt(len(rows[i]))
    kernel = np.zeros((len(rows), len(marks)))
    for i, r in enumerate(rows):
        at = np.minimum(np.searchsorted(vocabulary, r), len(vocabulary) - 1)
        kernel[i] = presence[at[vocabulary[at] == r]].sum(axis=0) / np.sqrt(len(r))
    values, vectors = np.linalg.eigh(kernel[marks])
    use = values > 1e-8 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])
    features = kernel @ root
    # every language weighs the same
    weight = (1 / np.bincount(y, minlength=len(names)))[y][:, None]
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0 if len(names) > 1 else 1.0)
    a = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(a, features.T @ (target * weight))
    return Model(names, vocabulary, (presence @ (root @ solved)).astype(np.float64))


def training_sample(docs: DataFrame, learn: Column, text: str, lang: str, per_language: int = PER_LANGUAGE) -> list:
    """At most ``per_language`` distinct texts (text, lang) of each language: texts of at most ``LONGEST_FITTED``
    characters first, then longer ones, each by the smallest hash, while a language's texts together have at
    most ``per_language * LONGEST_FITTED`` characters; the first text comes in any case, so that every
    language is learned.

    Hashes alone are ranked; the texts up to a language's last one are then read again, where they are: the
    ranks (a row per language, as the model has) go to them."""
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.length(text).alias("size"),
        F.struct((F.length(text) > LONGEST_FITTED).alias("long"), F.xxhash64(F.lit(7), text).alias("h")).alias("at"))
    order = Window.partitionBy("lang").orderBy("at")
    first = rows.select("lang", "at", "size").distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
    last = first.withColumn("total", F.sum("size").over(order)) \
        .where((F.col("k") == 1) | (F.col("total") <= per_language * LONGEST_FITTED)) \
        .groupBy(F.col("lang").alias("l")).agg(F.max("at").alias("last"))
    chosen = rows.join(F.broadcast(last), (F.col("lang") == F.col("l")) & (F.col("at") <= F.col("last")))
    return chosen.groupBy("lang", "at").agg(F.min("text").alias("text")).orderBy("lang", "at").select("text", "lang").collect()


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``: whole texts, whatever their length.

    A null text, one without a letter, or no model: ``und`` with score 0."""
    keep = [c for c in docs.columns if c != text]
    schema = schema_of(docs.select(*keep), lang_pred="string", score="double")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for b in rows_by_bytes(batches, text):
            values = b.column(b.schema.get_field_index(text)).to_pylist()
            names, scores = [UNKNOWN] * len(values), [0.0] * len(values)
            good = [i for i, t in enumerate(values) if model is not None and t is not None and LETTER.search(t)]
            if good:
                margins = model.margins([grams(values[i]) for i in good])
                best = margins.argmax(axis=1)
                for i, k, m in zip(good, best.tolist(), margins.max(axis=1).tolist()):
                    names[i], scores[i] = model.languages[k], min(1.0, max(0.0, (m + 1) / 2))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: one row per row of ``docs``.

    Learns from rows whose crc32 of the key as text is not 2 modulo 4 (a null key: neither held out nor
    learned from) and that have a language.  Repeated rows are rows; an empty table gives no rows; only
    the three named columns are read, and the language by the fit alone."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    fourth = F.crc32(F.col("doc_id").cast("string")) % 4
    sample = training_sample(rows, fourth != 2, "text", "lang", **options)
    model = fit([r["text"] for r in sample], [r["lang"] for r in sample])
    return predict(rows.select("doc_id", F.coalesce(fourth == 2, F.lit(False)).alias("held_out"), "text"), model)
