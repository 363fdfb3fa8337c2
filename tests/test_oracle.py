"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows_key, SPARK_TO_DUCK  # noqa: E402

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.sql(ORACLE[name])
    d_cols = res.columns
    assert sorted(sdf.columns) == sorted(d_cols)
    d_types = [str(t) for t in res.dtypes]
    order = [d_cols.index(c) for c in sdf.columns]
    s_types = [SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields]
    assert s_types == [d_types[i] for i in order]
    d_rows = [tuple(r[i] for i in order) for r in res.fetchall()]
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_rows) == rows_key(d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["ai_usage_bin", "n", "mean_salary", "median_salary", "mean_years_exp",
                          "mean_job_sat", "mean_org_size"]
    # FIXTURES.md: usage-bin counts of the respondents view at sf0.001
    assert {r.ai_usage_bin: r.n for r in rows} == {"0_None": 201, "1_Light_1to2": 247,
                                                   "2_Moderate_3to4": 414, "3_Heavy_5plus": 72}
