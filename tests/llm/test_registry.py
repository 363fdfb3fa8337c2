"""Registered queries run on the whole tables; those with SQL equal it."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from cohortlens.llm.oracle import ORACLE  # noqa: E402
from cohortlens.llm.queries import QUERIES  # noqa: E402
from oracle_check import duck, rows_key  # noqa: E402


def test_one_query_of_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op4_suffix_dedup"}))
def test_equals_sql(spark, sf_dir, name):
    res = duck(sf_dir).sql(ORACLE[name])
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(res.columns)
    assert rows_key([tuple(r) for r in got.select(*res.columns).collect()]) == rows_key(res.fetchall())


CONTRACT = {
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_hash_forest": ["query_id", "rank", "vec_id", "score"],
    "op11_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op12_embedding_neardup": ["vec_id", "n_links", "component_id", "kept"],
    "op13_centroid_clustering": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op9_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns[:len(CONTRACT[name])] == CONTRACT[name] and df.count() > 0
