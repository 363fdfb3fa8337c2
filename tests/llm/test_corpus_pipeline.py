"""The pipeline: every stage takes effect on all that the one before kept."""

import collections

import corpus_pipeline
import test_jaccard
import test_quality
from cohortlens.llm import jaccard, quality


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "suffix_dedup", "mixing", "packing"]
    columns, seen = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < 4:
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        seen.append(docs)
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality.judge(first)
    assert {r[0] for r in seen[0].select("doc_id").collect()} == {r[0] for r in judged.where("kept").select("doc_id").collect()}
    classes = jaccard.similarity_classes(seen[0]).where("doc_id = component_id").count()
    assert seen[1].count() == classes < seen[0].count()
    assert seen[2].selectExpr("sum(length(text))").first()[0] < seen[1].selectExpr("sum(length(text))").first()[0]
    assert seen[2].where("length(text) <> n_chars").count() == 0
    tokens = seen[4].selectExpr("sum(length)", "count(distinct doc_id)").first()
    assert tokens[0] > 0 and tokens[1] == seen[3].select("doc_id").distinct().count()
    assert seen[4].groupBy("sequence_id").sum("length").where("`sum(length)` <> 4096").count() <= 1


def first_of_classes(rows):
    """One row of each class of near duplicates, rows without an id all."""
    seen, out = set(), []
    for r, (i, _, least) in zip(rows, test_jaccard.brute(rows)):
        if i is None or (i == least and i not in seen):
            out.append(r)
            seen.add(i)
    return out


def without_repeats(rows, length=200):
    """Rows without the bytes of strings that come more than once; rows that lose all go."""
    texts = [r[1].encode() for r in rows]
    count = collections.Counter(x[i:i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for r, x in zip(rows, texts):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if count[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(b for b, g in zip(x, gone) if not g).decode("utf-8", "ignore")
        if not any(gone) or left:
            out.append((*r[:1], left, *r[2:4], len(left) if any(gone) else r[4], *r[5:]))
    return out


def test_chain_equals_brute_force(spark, docs, rows, tmp_path):
    """Texts and ids after each of the first three stages; the totals of the other two."""
    copies = [(200 + i, rows[0][1] + "\nown " + str(i), "en", "s0", None, *rows[0][5:]) for i in range(3)]
    shared = "\n".join(rows[k][1] for k in (4, 5))  # a passage of two texts, in texts that are not near duplicates
    copies += [(210 + i, test_quality.__name__.join(rows[6 + i][1].split(" ")) + " " + rows[6 + i][1] + "\n" + shared, "en", "s9", 7, *rows[0][5:]) for i in range(2)]
    want = [r for r in rows if r[0] != 85] + copies
    df = spark.createDataFrame(want, docs.schema).repartition(4)
    for k, (step, (_, stage)) in enumerate(zip((test_quality.brute_texts, first_of_classes, without_repeats), corpus_pipeline.STAGES)):
        stage(spark, df, "").write.parquet(str(tmp_path / str(k)))
        df = spark.read.parquet(str(tmp_path / str(k)))
        before, want = want, step(want)
        assert df.columns == docs.columns and sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
        assert 5 < len(want) and {r[1] for r in want} != {r[1] for r in before}  # the stage took effect
    mixed = corpus_pipeline.mixed(spark, df, "")
    taken = collections.Counter((r[0], r[1]) for r in mixed.collect())
    assert set(taken) <= {(r[0], r[1]) for r in want} and max(taken.values()) <= 3
    pieces = corpus_pipeline.packed(spark, df, "").collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in want}


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() > 0
