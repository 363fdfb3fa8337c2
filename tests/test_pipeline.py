"""End to end: raw survey rows -> K-Means archetypes -> 19 tables written and read back."""

import glob
import os
import subprocess
import sys

import pytest

from cohortlens.plans.pipeline import run
from cohortlens.session import shared_folder
from cohortlens.sources import raw_survey_shape, read_catalogue, respondents

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _stage_files(spark):
    return glob.glob(shared_folder(spark).removeprefix("file:") + "/cohortlens-*")

IMPACT = ["cluster_sizes", "salary_by_archetype", "jobsat_by_archetype", "ai_tool_adoption_by_archetype",
          "tech_stack_by_archetype", "profile_by_archetype", "remote_work_by_archetype",
          "main_branch_by_archetype", "primary_role_by_archetype", "summary_by_archetype",
          "top_countries_by_archetype", "top_devroles_by_archetype"]
DEEP = ["deep_salary_by_ai_usage", "deep_salary_by_exp_x_ai", "deep_counts_by_exp_x_ai",
        "deep_salary_by_country_x_ai", "deep_salary_by_role_x_ai", "deep_correlations",
        "deep_regression_coefficients", "deep_regression_fit", "deep_regression_marks", "final_model"]


def test_run_writes_every_table(spark, sf_dir, tmp_path):
    raw = raw_survey_shape(respondents(spark, sf_dir))
    out, before = str(tmp_path / "report"), set(_stage_files(spark))
    tables = run(raw, k=3, ks=range(2, 4), out_dir=out, fmt="csv")
    back = read_catalogue(spark, out)
    for name in IMPACT + DEEP + ["k_sweep", "centroids", "clean_funnel"]:
        assert name in tables, name
        assert back[name].dtypes == tables[name].dtypes
        assert sorted(map(tuple, back[name].collect()), key=str) == sorted(map(tuple, tables[name].collect()), key=str), name
    lab = back["labelled_developers"]
    assert "features" not in lab.columns and "archetype" in lab.columns
    assert lab.count() == 934  # clean rows at sf0.001 (FIXTURES.md)
    assert tables["deep_correlations"].count() == 45
    assert tables["deep_regression_coefficients"].count() == 4
    assert [r.k for r in tables["k_sweep"].orderBy("k").collect()] == [2, 3]
    fit, final = tables["deep_regression_fit"].first(), tables["final_model"].first()
    assert fit.n == 934 and 0 <= fit.r2 <= 1 and fit.rmse > 0
    assert final.k == 3 and -1 <= final.silhouette <= 1 and final.wssse > 0
    assert {"significance", "direction", "verdict"} <= set(tables["deep_regression_marks"].columns)
    assert set(_stage_files(spark)) > before
    tables.release()  # what the run wrote for itself is gone, what others wrote and the catalogue stay
    assert set(_stage_files(spark)) == before
    assert read_catalogue(spark, out)["cluster_sizes"].count() == 3


def test_run_on_another_survey(spark, sf_dir):
    """Other separator, answers, bounds, bins and model columns: everything comes from the spec."""
    from pyspark.sql import functions as F

    from cohortlens.spec import SurveySpec

    raw = respondents(spark, sf_dir)
    for c in ("AIBen", "AIToolActivities", "AIProducts", "LanguageHaveWorkedWith", "DevType"):
        raw = raw.withColumn(c, F.translate(c, ";", "|"))
    raw = raw.withColumn("Employment", F.replace(F.col("Employment"), F.lit("Employed, full-time"), F.lit("FT"))) \
        .withColumn("OrgSize", F.when(F.col("OrgSize").startswith("1"), F.lit("large")).otherwise(F.lit("small")))
    base = SurveySpec()
    spec = SurveySpec(
        separator="|", employed_marker="FT", salary_bounds=(0, 10_000_000), ai_tools=("ChatGPT", "Claude"), languages=("Go", "SQL"),
        ordinals={**base.ordinals, "org_size_int": ("OrgSize", {"small": 0, "large": 1}, None)},
        usage_bins=(("few", 2), ("many", None)), experience_bins=(("new", 5), ("old", None)),
        cluster_features=("ai_product_count", "years_code_pro"), rank_feature="ai_product_count",
        correlation_columns=("salary_usd", "job_sat_int", "org_size_int"), regression_features=("years_code_pro", "org_size_int"))
    tables = run(raw, spec, k=2, ks=None)
    assert tables["ai_tool_adoption_by_archetype"].columns[-2:] == ["uses_chatgpt_pct", "uses_claude_pct"]
    assert tables["tech_stack_by_archetype"].columns == ["archetype", "lang_go_pct", "lang_sql_pct"]
    assert {r[0] for r in tables["deep_salary_by_ai_usage"].collect()} <= {"few", "many"}
    assert tables["deep_salary_by_exp_x_ai"].columns == ["experience_bin", "few", "many"]
    assert tables["deep_correlations"].count() == 3
    assert [r.feature for r in tables["deep_regression_coefficients"].collect()] == ["years_code_pro", "org_size_int"]
    assert tables["cluster_sizes"].count() == 2
    assert tables["labelled"].agg(F.max("org_size_int"), F.max("ai_product_count")).first()[1] > 1


def test_run_on_a_survey_with_other_columns(spark, sf_dir):
    """Other column names, answers of shares, means and cleaning steps; and no company size at all."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from cohortlens.spec import SURVEY

    names = {"ConvertedCompYearly": "pay", "JobSat": "happy", "YearsCodePro": "years", "AIBen": "gains", "AIProducts": "products",
             "AIToolActivities": "uses", "LanguageHaveWorkedWith": "langs", "Country": "nation", "DevType": "jobs", "Employment": "work",
             "RemoteWork": "place", "MainBranch": "kind"}
    raw = respondents(spark, sf_dir)
    other = raw.withColumnsRenamed(names).drop("OrgSize")
    ordinals = {k: v for k, v in SURVEY.ordinals.items() if k != "org_size_int"}
    spec = replace(
        SURVEY, selected=tuple(names.get(c, c) for c in SURVEY.selected if c != "OrgSize"), renames={}, ordinals=ordinals,
        roles={k: names[c] for k, c in SURVEY.roles.items()}, outcome_columns=("pay", "happy"),
        funnel=("employed_full_time", "outcomes_present", "salary_in_range", "years_known", "job_sat_in_range"),
        remote_work=("place", ("Remote",), ("far",)), main_branch=("kind", SURVEY.main_branch[1][:2], ("pro", "some")),
        profile_means=(("ai_sent_int", "mood", 1),), summary_means=(("job_sat_int", "happy", 1), ("salary_usd", "pay", 0)),
        cluster_features=("ai_product_count", "years_code_pro"), correlation_columns=("salary_usd", "job_sat_int"),
        regression_features=("years_code_pro", "ai_product_count"))
    tables = run(other, spec, k=2, ks=None)
    assert [r.step for r in tables["clean_funnel"].collect()] == ["raw", *spec.funnel]
    n = raw.where("contains(Employment, 'Employed, full-time') and try_cast(ConvertedCompYearly as double) > 5000 "
                  "and try_cast(ConvertedCompYearly as double) < 1000000 and JobSat is not null").select("ConvertedCompYearly").count()
    assert 0 < tables["labelled"].count() == tables["cluster_sizes"].agg(F.sum("count")).first()[0] <= n
    assert tables["remote_work_by_archetype"].columns == ["archetype", "total", "far"]
    assert tables["main_branch_by_archetype"].columns == ["archetype", "total", "pro", "some"]
    assert tables["profile_by_archetype"].columns == ["archetype", "mood"]
    order = [r.happy for r in tables["summary_by_archetype"].collect()]
    assert tables["summary_by_archetype"].columns == ["archetype", "developers", "happy", "pay"] and order == sorted(order, reverse=True)
    assert tables["deep_salary_by_country_x_ai"].columns[0] == "nation" and tables["deep_salary_by_country_x_ai"].count() == 5
    assert tables["top_countries_by_archetype"].count() > 0 and tables["top_devroles_by_archetype"].count() > 0
    assert {r.mean_org_size for r in tables["deep_salary_by_ai_usage"].collect()} == {None}
    tables.release()
    with pytest.raises(ValueError, match="org_size_known"):
        run(other, replace(spec, funnel=SURVEY.funnel), k=2, ks=None)


@pytest.mark.parametrize("source", ["csv", "tables"])
def test_command_line_runs_everything_and_leaves_no_stage_file(spark, sf_dir, tmp_path, source):
    """``python -m cohortlens`` on a survey file or on the driver tables: prints, publishes, cleans up."""
    args = ["--sf-dir", sf_dir, "--format", "parquet"]
    if source == "csv":
        path = tmp_path / "survey.csv"
        raw_survey_shape(respondents(spark, sf_dir)).toPandas().to_csv(path, index=False, na_rep="NA")
        args = ["--csv", str(path)]
    env = {**os.environ, "PYTHONPATH": ROOT, "COHORTLENS_DRIVER_MEMORY": "2g"}
    got = subprocess.run([sys.executable, "-m", "cohortlens", *args, "--out", str(tmp_path / "out"), "--k", "2", "--no-sweep", "--master", "local[4]"],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=500)
    assert got.returncode == 0, got.stderr[-2000:]
    assert "== cluster_sizes" in got.stdout and "== k_sweep" not in got.stdout
    tables = read_catalogue(spark, str(tmp_path / "out"))
    assert set(IMPACT + DEEP) <= set(tables) and tables["cluster_sizes"].count() == 2 and tables["clean_funnel"].count() == 8
    assert glob.glob(str(tmp_path / "spark-warehouse" / "stages" / "cohortlens-*")) == []
