"""The stateless operators run unchanged on a stream."""

import os
import tempfile

from cohortlens.sources.respondents import respondents
from cohortlens.streaming import features_stream, read_responses_stream
from cohortlens.plans import stages


def test_features_stream_matches_batch(spark, sf_dir):
    raw = respondents(spark, sf_dir)
    d = tempfile.mkdtemp(prefix="cohortlens-stream-")
    src = os.path.join(d, "in")
    raw.write.parquet(src)
    stream = read_responses_stream(spark, src, raw.schema)
    q = features_stream(stream).writeStream.format("memory").queryName("feat_stream") \
        .option("checkpointLocation", os.path.join(d, "ckpt")).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT ResponseId, ai_product_count, uses_chatgpt FROM feat_stream")
    want = stages.feature_table(spark, sf_dir).select("ResponseId", "ai_product_count", "uses_chatgpt")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_score_stream_matches_batch_assignment(spark, sf_dir):
    from pyspark.sql import functions as F

    from cohortlens.operators import cluster
    from cohortlens.spec import CLUSTER_FEATURES
    from cohortlens.streaming import score_stream

    feats = stages.feature_table(spark, sf_dir)
    stats = feats.agg(*[F.avg(c).alias(f"__m_{c}") for c in CLUSTER_FEATURES],
                      *[F.stddev_samp(c).alias(f"__s_{c}") for c in CLUSTER_FEATURES])
    z = stages.z_table(spark, sf_dir)
    centres = cluster.seeded_centres(z, stages.SEED_COLUMN, stages.Z_FEATURES)
    labels = cluster.label_table(centres, "z_ai_product_count")
    want = {r.ResponseId: r.archetype for r in stages.labelled_fixed(spark, sf_dir).collect()}

    raw = respondents(spark, sf_dir)
    d = tempfile.mkdtemp(prefix="cohortlens-stream-")
    raw.write.parquet(os.path.join(d, "in"))
    stream = features_stream(read_responses_stream(spark, os.path.join(d, "in"), raw.schema))
    scored = score_stream(stream, centres, labels, CLUSTER_FEATURES, stats)
    q = scored.select("ResponseId", "archetype").writeStream.format("memory").queryName("scored_stream") \
        .option("checkpointLocation", os.path.join(d, "ckpt")).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.ResponseId: r.archetype for r in spark.sql("SELECT * FROM scored_stream").collect()}
    assert got == want
