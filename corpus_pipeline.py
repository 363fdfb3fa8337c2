"""Corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import jaccard, mixing, packing, quality, suffixes
from cohortlens.llm.queries import tokenizer_path
from cohortlens.llm.util import Stages


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the quality rules reject go."""
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each class of near duplicates the document with the smallest doc_id stays."""
    return jaccard.keep_first(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: bytes of passages that occur elsewhere too go."""
    return suffixes.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: each document comes as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of sequences of 4096 ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality_rules", good_documents), ("jaccard_join", distinct_documents), ("suffix_dedup", unrepeated),
          ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again as the next one's
    input; an operator's own tables go once its stage is written."""
    before = list(Stages.made)
    own = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = own.write(stage(spark, docs, sf_dir), name)
        Stages.drop_all(keep=[*before, own])
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
