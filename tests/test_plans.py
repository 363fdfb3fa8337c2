"""Physical-plan checks: no Python in the hot path, shared scans, pruning at the source."""

import re

import pytest

import __spark_entry__ as entry
from cohortlens.plans import report, stages

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["clean", "multi_hot_products", "assign_fixed_centers", "silhouette_fixed",
                                  "salary_by_archetype", "top_devroles", "box_stats"])
def test_no_python_evaluation(spark, sf_dir, name):
    text = plan_text(entry.queries()[name](spark, sf_dir))
    assert not any(n in text for n in PY_NODES), name


def test_profile_is_one_scan_of_the_labelled_table(spark, sf_dir):
    lab = stages.binned_fixed(spark, sf_dir)
    prof = report.cohort_profile(lab, quantile_method="exact")
    text = prof._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", text)) == 1


def test_respondents_scan_is_pruned(spark, sf_dir):
    from cohortlens.sources.respondents import respondents
    text = respondents(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    orders = [s for s in schemas if "o_orderkey" in s][0]
    assert "o_orderdate" not in orders and "o_comment" not in orders


def test_assignment_has_no_per_point_pairs(spark, sf_dir):
    text = plan_text(entry.queries()["assign_fixed_centers"](spark, sf_dir))
    # the only nested-loop join is against the ONE packed-centres row
    assert "CartesianProduct" not in text
    assert "Generate" not in text and "explode" not in text.lower()


def test_role_mix_wide_equals_long(spark, sf_dir):
    from cohortlens.functions.recode import role_column_name
    lab = stages.binned_fixed(spark, sf_dir)
    wide = {r.archetype: r.asDict() for r in report.impact_report(lab)["primary_role_by_archetype"].collect()}
    long = report.primary_role_mix_long(lab).collect()
    assert long
    for r in long:
        assert wide[r.archetype][role_column_name(r.primary_role)] == r.pct
        assert wide[r.archetype]["total"] == r.total
