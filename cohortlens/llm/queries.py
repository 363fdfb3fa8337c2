"""The registered query of each operator, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import audit, centroids, forest, jaccard, language, mixing, neardup, packing, preferences, quality, sharding, suffixes, warc
from .util import Stages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with another last assistant turn: pairs that share turns, as the
    table holds no preferences."""
    made = preferences.last_turn_pairs(table(spark, sf_dir, "conversations"))
    return made.withColumns({c: preferences.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("digest")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).drop("range_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Stages(spark, "warc").path("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    return warc.read_archives(spark, path, with_payload=False).where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return forest.nearest(rows, rows.where("vec_id % 20 = 0"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mix(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_packing, op3_preferences, op4_suffix_dedup, op5_sharding, op6_warc, op7_language, op8_hash_forest,
    op9_mixing, op10_jaccard_join, op11_filter_audit, op12_embedding_neardup, op13_centroid_clustering)}
