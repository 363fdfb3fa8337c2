"""Cohort report tables over a labelled table (one row per respondent with ``archetype``).

The single-table builders are lazy.  ``impact_report`` and ``deep_dive`` run now: they write
the small shared aggregates (k rows, or one row per cell) once to the shared folder and derive
their tables from those; nothing stays cached.  The labelled table should be materialised once
by the caller, because several aggregates scan it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.recode import role_column_name, round_half_up
from ..operators import crosstab, stats, topn
from ..operators.features import add_bins
from ..session import materialize
from ..operators.quantiles import grouped_quantiles, null_safe
from ..operators.summary import Measure, group_means, indicator_rates, summarize
from ..spec import SURVEY, UNKNOWN_ROLE, USAGE_BINS, SurveySpec
from ..functions.recode import safe_name

A = "archetype"
USAGE_VALUES = [label for label, _ in USAGE_BINS]


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("prediction", A).agg(F.count(F.lit(1)).alias("count")).orderBy("prediction")


def salary_by_archetype(df: DataFrame, quantile_method: str = "bracketed") -> DataFrame:
    ms = [Measure("n", "count", "salary_usd"),
          Measure("mean_salary", "mean", "salary_usd", 2),
          Measure("stddev_salary", "stddev", "salary_usd", 2),
          Measure("p25_salary", "quantile", "salary_usd", 2, 0.25),
          Measure("median_salary", "quantile", "salary_usd", 2, 0.5),
          Measure("p75_salary", "quantile", "salary_usd", 2, 0.75)]
    return summarize(df, A, ms, order=[F.desc("mean_salary"), F.asc(A)], quantile_method=quantile_method)


def jobsat_by_archetype(df: DataFrame, quantile_method: str = "exact") -> DataFrame:
    ms = [Measure("n", "count", "job_sat_int"),
          Measure("mean_job_sat", "mean", "job_sat_int", 3),
          Measure("stddev_job_sat", "stddev", "job_sat_int", 3),
          Measure("median_job_sat", "quantile", "job_sat_int", 1, 0.5)]
    return summarize(df, A, ms, order=[F.desc("mean_job_sat"), F.asc(A)], quantile_method=quantile_method)


def tool_columns(spec: SurveySpec = SURVEY) -> list[str]:
    return ["uses_" + safe_name(t) for t in spec.ai_tools]


def language_columns(spec: SurveySpec = SURVEY) -> list[str]:
    return ["lang_" + safe_name(v) for v in spec.languages]


def ai_tool_adoption(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    lead = [Measure("n", "rows"), Measure("avg_products", "mean", "ai_product_count", 2),
            Measure("avg_tasks", "mean", "ai_task_count", 2)]
    return indicator_rates(df, A, tool_columns(spec), leading=lead, order=[F.desc("avg_products"), F.asc(A)])


def tech_stack(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return indicator_rates(df, A, language_columns(spec), order=[F.asc(A)])


def profile_by_archetype(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return group_means(df, A, spec.profile_means, order=[F.asc(A)])


def remote_work_mix(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return crosstab.share_pivot(df, A, *spec.remote_work, denom="non_null")


def main_branch_mix(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return crosstab.share_pivot(df, A, *spec.main_branch, denom="non_null")


def with_primary_role(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return df if "primary_role" in df.columns else add_bins(df, spec)


def top_roles(df: DataFrame, k: int = 8, include_unknown: bool = False) -> DataFrame:
    """Global top-k primary roles; ``Unknown`` excluded unless asked."""
    return crosstab.topk(with_primary_role(df), "primary_role", k,
                         exclude=() if include_unknown else (UNKNOWN_ROLE,))


def primary_role_mix_long(df: DataFrame, k: int = 8) -> DataFrame:
    """``(archetype, primary_role, n, total, pct)``: share of each archetype's rows (all
    rows, ``Unknown`` included in the total) in each global top-k role."""
    d = with_primary_role(df)
    return crosstab.share_long(d, A, "primary_role", top_roles(d, k))


def primary_role_mix(df: DataFrame, k: int = 8) -> DataFrame:
    """Wide form with one ``<role>_pct`` column per top role, from one scan's counts.  The column set depends on
    the data, so the k role names (bounded by k) are fetched to name the columns."""
    top, long = role_mix_from_counts(materialize(role_counts(df), "role-cells"), k)
    roles = [r[0] for r in top.select("primary_role").collect()]
    return crosstab.share_wide(long, A, "primary_role", roles, [role_column_name(r) for r in roles])


def summary_by_archetype(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return group_means(df, A, spec.summary_means, leading=[Measure("developers", "rows")], order=_summary_order(spec))


def _summary_order(spec: SurveySpec) -> list:
    """By the first mean, largest first."""
    return [F.desc(alias) for _, alias, _ in spec.summary_means[:1]] + [F.asc(A)]


def top_countries(df: DataFrame, n: int = 5, spec: SurveySpec = SURVEY) -> DataFrame:
    return topn.topn_per_group(df, A, spec.roles["country"], n, out="country")


def top_devroles(df: DataFrame, n: int = 5, spec: SurveySpec = SURVEY) -> DataFrame:
    return topn.topn_items_per_group(df, A, spec.roles["dev_roles"], n, out="dev_role", sep=spec.separator)


def impact_report_separate(df: DataFrame, quantile_method: str = "exact") -> dict[str, DataFrame]:
    """The 12 cohort tables, each its own scan of ``df`` (reference layout)."""
    return {
        "cluster_sizes": cluster_sizes(df),
        "salary_by_archetype": salary_by_archetype(df, quantile_method),
        "jobsat_by_archetype": jobsat_by_archetype(df, quantile_method),
        "ai_tool_adoption_by_archetype": ai_tool_adoption(df),
        "tech_stack_by_archetype": tech_stack(df),
        "profile_by_archetype": profile_by_archetype(df),
        "remote_work_by_archetype": remote_work_mix(df),
        "main_branch_by_archetype": main_branch_mix(df),
        "primary_role_by_archetype": primary_role_mix(df),
        "summary_by_archetype": summary_by_archetype(df),
        "top_countries_by_archetype": top_countries(df),
        "top_devroles_by_archetype": top_devroles(df),
    }


# ---------------------------------------------------------------------------
# shared scans: every per-archetype table from ONE aggregate
# ---------------------------------------------------------------------------

def _mean_columns(spec: SurveySpec = SURVEY) -> list[str]:
    cols = ["salary_usd", "job_sat_int", "ai_product_count", "ai_task_count"]
    cols += tool_columns(spec) + language_columns(spec)
    cols += [c for c, _, _ in spec.profile_means + spec.summary_means]
    return list(dict.fromkeys(cols))


def cohort_profile(df: DataFrame, quantile_method: str = "bracketed", spec: SurveySpec = SURVEY) -> DataFrame:
    """All per-archetype measures of the report in one ``groupBy().agg()`` (k rows).

    Salary quantiles use ``quantile_method`` (bracketed: exact with bounded memory); the
    job-satisfaction median is a 0-10 score, so plain ``percentile`` stays bounded.
    """
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.count("salary_usd").alias("n_salary"), F.stddev_samp("salary_usd").alias("sd_salary_usd"),
            F.count("job_sat_int").alias("n_job_sat"), F.stddev_samp("job_sat_int").alias("sd_job_sat_int"),
            F.percentile("job_sat_int", 0.5).alias("q50_job_sat_int")]
    aggs += [F.avg(c).alias("avg_" + c) for c in _mean_columns(spec)]
    for p, (c, values, _) in (("rw", spec.remote_work), ("mb", spec.main_branch)):
        aggs += [F.count(c).alias(p + "_total")] + [F.count_if(F.col(c) == v).alias(f"{p}{i}") for i, v in enumerate(values)]
    qs, names = [0.25, 0.5, 0.75], ["q25_salary", "q50_salary", "q75_salary"]
    if quantile_method == "exact":
        aggs += [F.percentile("salary_usd", q).alias(n) for q, n in zip(qs, names)]
    prof = df.groupBy("prediction", A).agg(*aggs)
    if quantile_method != "exact":
        prof = null_safe(prof, grouped_quantiles(df, [A], "salary_usd", qs, names, method=quantile_method), [A], "left")
    return prof


def _r(c, d):
    return round_half_up(c, d)


def tables_from_profile(prof: DataFrame, spec: SurveySpec = SURVEY) -> dict[str, DataFrame]:
    """The nine per-archetype tables as projections of the profile."""
    pct = lambda c, t: _r(F.col(c) * 100.0 / F.col(t), 1)
    means = lambda wanted: [_r(F.col("avg_" + c), d).alias(a) for c, a, d in wanted]
    out = {
        "cluster_sizes": prof.select("prediction", A, F.col("rows").alias("count")).orderBy("prediction"),
        "salary_by_archetype": prof.select(
            A, F.col("n_salary").alias("n"), _r("avg_salary_usd", 2).alias("mean_salary"),
            _r("sd_salary_usd", 2).alias("stddev_salary"), _r("q25_salary", 2).alias("p25_salary"),
            _r("q50_salary", 2).alias("median_salary"), _r("q75_salary", 2).alias("p75_salary"))
            .orderBy(F.desc("mean_salary"), F.asc(A)),
        "jobsat_by_archetype": prof.select(
            A, F.col("n_job_sat").alias("n"), _r("avg_job_sat_int", 3).alias("mean_job_sat"),
            _r("sd_job_sat_int", 3).alias("stddev_job_sat"), _r("q50_job_sat_int", 1).alias("median_job_sat"))
            .orderBy(F.desc("mean_job_sat"), F.asc(A)),
        "ai_tool_adoption_by_archetype": prof.select(
            A, F.col("rows").alias("n"), _r("avg_ai_product_count", 2).alias("avg_products"),
            _r("avg_ai_task_count", 2).alias("avg_tasks"),
            *[_r(F.col("avg_" + c) * 100, 1).alias(c + "_pct") for c in tool_columns(spec)])
            .orderBy(F.desc("avg_products"), F.asc(A)),
        "tech_stack_by_archetype": prof.select(
            A, *[_r(F.col("avg_" + c) * 100, 1).alias(c + "_pct") for c in language_columns(spec)]).orderBy(A),
        "profile_by_archetype": prof.select(A, *means(spec.profile_means)).orderBy(A),
        "remote_work_by_archetype": prof.where(F.col("rw_total") > 0).select(
            A, F.col("rw_total").alias("total"),
            *[pct(f"rw{i}", "rw_total").alias(a) for i, a in enumerate(spec.remote_work[2])]).orderBy(A),
        "main_branch_by_archetype": prof.where(F.col("mb_total") > 0).select(
            A, F.col("mb_total").alias("total"),
            *[pct(f"mb{i}", "mb_total").alias(a) for i, a in enumerate(spec.main_branch[2])]).orderBy(A),
        "summary_by_archetype": prof.select(A, F.col("rows").alias("developers"), *means(spec.summary_means))
            .orderBy(*_summary_order(spec)),
    }
    return out


def role_counts(df: DataFrame) -> DataFrame:
    """Rows per (archetype, primary role): every role-mix number derives from this."""
    return with_primary_role(df).groupBy(A, "primary_role").agg(F.count(F.lit(1)).alias("n"))


def role_mix_from_counts(rc: DataFrame, k: int = 8) -> tuple[DataFrame, DataFrame]:
    """(top-k roles, long role mix) from the per-(archetype, role) counts."""
    top = rc.where(F.col("primary_role").isNotNull() & (F.col("primary_role") != UNKNOWN_ROLE)) \
        .groupBy("primary_role").agg(F.sum("n").alias("count")) \
        .orderBy(F.desc("count"), F.asc("primary_role")).limit(k)
    totals = rc.groupBy(A).agg(F.sum("n").alias("total"))
    cells = rc.join(F.broadcast(top.select("primary_role")), on="primary_role", how="left_semi")
    long = null_safe(cells, totals, [A]).select(A, "primary_role", "n", "total",
                                          _r(F.col("n") * 100.0 / F.col("total"), 1).alias("pct")) \
        .orderBy(A, "primary_role")
    return top, long


def impact_report(df: DataFrame, quantile_method: str = "bracketed", spec: SurveySpec = SURVEY) -> dict[str, DataFrame]:
    """The 12 cohort tables, by output name, from shared scans of ``df``.

    Scans of the labelled table: one profile aggregate (+ the bracketed salary quantiles),
    one per-(archetype, role, country) count and one over the exploded roles.  The small
    intermediate aggregates are written once, so the derived tables do not re-scan.
    """
    prof = materialize(cohort_profile(df, quantile_method, spec), "profile")
    out = tables_from_profile(prof, spec)
    # one small count table per (archetype, role, country) serves both the role mix and the
    # per-archetype country ranking
    country = spec.roles["country"]
    cells = materialize(with_primary_role(df, spec).groupBy(A, "primary_role", country)
                        .agg(F.count(F.lit(1)).alias("n")), "role-cells")
    rc = cells.groupBy(A, "primary_role").agg(F.sum("n").alias("n"))
    top, long = role_mix_from_counts(rc)
    roles = [r[0] for r in top.select("primary_role").collect()]  # k names, to name k columns
    out["primary_role_by_archetype"] = crosstab.share_wide(long, A, "primary_role", roles,
                                                           [role_column_name(r) for r in roles])
    out["top_countries_by_archetype"] = topn.topn_per_group(cells, A, country, 5, out="country", weight="n")
    out["top_devroles_by_archetype"] = top_devroles(df, spec=spec)
    order = ["cluster_sizes", "salary_by_archetype", "jobsat_by_archetype", "ai_tool_adoption_by_archetype",
             "tech_stack_by_archetype", "profile_by_archetype", "remote_work_by_archetype",
             "main_branch_by_archetype", "primary_role_by_archetype", "summary_by_archetype",
             "top_countries_by_archetype", "top_devroles_by_archetype"]
    return {n: out[n] for n in order}


# ---------------------------------------------------------------------------
# confounder controls
# ---------------------------------------------------------------------------

def salary_by_usage(b: DataFrame, quantile_method: str = "bracketed") -> DataFrame:
    ms = [Measure("n", "rows"),
          Measure("mean_salary", "mean", "salary_usd", 0),
          Measure("median_salary", "quantile", "salary_usd", 0, 0.5),
          Measure("mean_years_exp", "mean", "years_code_pro", 1),
          Measure("mean_job_sat", "mean", "job_sat_int", 2),
          Measure("mean_org_size", "mean", "org_size_int", 2)]
    return summarize(b, "ai_usage_bin", ms, order=[F.asc("ai_usage_bin")], quantile_method=quantile_method)


def salary_exp_x_usage(b: DataFrame) -> DataFrame:
    return crosstab.pivot_mean(b, "experience_bin", "ai_usage_bin", USAGE_VALUES, "salary_usd", 0)


def counts_exp_x_usage(b: DataFrame) -> DataFrame:
    return crosstab.pivot_count(b, "experience_bin", "ai_usage_bin", USAGE_VALUES)


def salary_country_x_usage(b: DataFrame, k: int = 5) -> DataFrame:
    top = crosstab.topk(b, "Country", k)
    return crosstab.pivot_mean(crosstab.filter_topk(b, "Country", top), "Country", "ai_usage_bin",
                               USAGE_VALUES, "salary_usd", 0, order=[F.desc("Country")])


def salary_role_x_usage(b: DataFrame, k: int = 8) -> DataFrame:
    top = crosstab.topk(b, "primary_role", k)  # Unknown included here
    return crosstab.pivot_mean(crosstab.filter_topk(b, "primary_role", top), "primary_role",
                               "ai_usage_bin", USAGE_VALUES, "salary_usd", 0)


def correlations(b: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    return stats.corr_pairs(b, spec.correlation_columns, digits=3)


def regression(b: DataFrame, spec: SurveySpec = SURVEY):
    """``(model, coefficient table, fit stats)`` of salary on AI use and controls."""
    model, _ = stats.fit_ols(b, spec.regression_label, spec.regression_features)
    return model, stats.coefficient_table(model, spec.regression_features, b.sparkSession), \
        stats.fit_stats(model, b.sparkSession)


def usage_cells(b: DataFrame, row: str) -> DataFrame:
    """Rows and mean salary per (row key, usage bin): the input of a two-way table."""
    return b.groupBy(row, "ai_usage_bin").agg(F.count(F.lit(1)).alias("n"), F.avg("salary_usd").alias("m"))


def pivot_cells(cells: DataFrame, row: str, value: str, digits: int | None = 0, values=USAGE_VALUES) -> DataFrame:
    v = F.first(value)
    agg = _r(v, digits) if digits is not None else v
    return cells.groupBy(row).pivot("ai_usage_bin", list(values)).agg(agg)


def top_from_cells(cells: DataFrame, row: str, k: int) -> DataFrame:
    return cells.where(F.col(row).isNotNull()).groupBy(row).agg(F.sum("n").alias("count")) \
        .orderBy(F.desc("count"), F.asc(row)).limit(k)


def deep_dive(df: DataFrame, quantile_method: str = "bracketed", spec: SurveySpec = SURVEY) -> dict[str, DataFrame]:
    """The 7 confounder-control tables and the model's fit statistics and marks, by output name
    (the OLS fit runs here)."""
    b = df if "ai_usage_bin" in df.columns else add_bins(df, spec)
    _, coefs, fit = regression(b, spec)
    out = deep_dive_tables(b, quantile_method=quantile_method, spec=spec)
    return {
        "deep_salary_by_ai_usage": out["deep_salary_by_ai_usage"],
        "deep_salary_by_exp_x_ai": out["deep_salary_by_exp_x_ai"],
        "deep_counts_by_exp_x_ai": out["deep_counts_by_exp_x_ai"],
        "deep_salary_by_country_x_ai": out["deep_salary_by_country_x_ai"],
        "deep_salary_by_role_x_ai": out["deep_salary_by_role_x_ai"],
        "deep_correlations": correlations(b, spec).drop("pair_no"),
        "deep_regression_coefficients": coefs,
        "deep_regression_fit": fit,
        "deep_regression_marks": stats.coefficient_marks(coefs),
    }


def deep_cells(b: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Counts and sums per (experience, country, role, usage) cell from one scan: a small table (bins × countries
    × roles) from which every two-way table is rolled up."""
    sums = [("salary_usd", "s", "c"), ("years_code_pro", "sy", "cy"), ("job_sat_int", "sj", "cj")]
    sums += [("org_size_int", "so", "co")] if "org_size_int" in b.columns else []
    return b.groupBy("experience_bin", spec.roles["country"], "primary_role", "ai_usage_bin").agg(
        F.count(F.lit(1)).alias("n"),
        *[a for col, sname, cname in sums for a in (F.sum(col).alias(sname), F.count(col).alias(cname))])


def deep_dive_tables(df: DataFrame, with_usage: bool = True, quantile_method: str = "bracketed",
                     spec: SurveySpec = SURVEY, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four two-way tables (and, with ``with_usage``, the usage-bin summary) from one
    per-cell aggregate (``deep_cells``, unless given), written once: cell means, counts and top-k lists share a
    single scan of the labelled table."""
    b = df if "ai_usage_bin" in df.columns else add_bins(df, spec)
    cells = materialize(deep_cells(b, spec), "cells") if cells is None else cells
    usage, country = [label for label, _ in spec.usage_bins], spec.roles["country"]

    def roll(row):
        return cells.groupBy(row, "ai_usage_bin").agg(
            F.sum("n").alias("n"), F.try_divide(F.sum("s"), F.sum("c")).alias("m"))

    exp_cells, country_cells, role_cells = roll("experience_bin"), roll(country), roll("primary_role")
    top_c = top_from_cells(country_cells, country, 5)
    top_r = top_from_cells(role_cells, "primary_role", 8)
    out = {}
    if with_usage:
        out["deep_salary_by_ai_usage"] = _usage_summary(b, cells, quantile_method)
    out["deep_salary_by_exp_x_ai"] = pivot_cells(exp_cells, "experience_bin", "m", values=usage).orderBy("experience_bin")
    out["deep_counts_by_exp_x_ai"] = pivot_cells(exp_cells, "experience_bin", "n", None, usage).orderBy("experience_bin")
    out["deep_salary_by_country_x_ai"] = pivot_cells(
        crosstab.filter_topk(country_cells, country, top_c), country, "m", values=usage).orderBy(F.desc(country))
    out["deep_salary_by_role_x_ai"] = pivot_cells(
        crosstab.filter_topk(role_cells, "primary_role", top_r), "primary_role", "m", values=usage).orderBy("primary_role")
    return out


def _usage_summary(b: DataFrame, cells: DataFrame, quantile_method: str) -> DataFrame:
    """Usage-bin summary: means rolled up from the cells, the median from the rows."""
    def mean(sname, cname):
        return F.try_divide(F.sum(sname), F.sum(cname))

    usage = cells.groupBy("ai_usage_bin").agg(
        F.sum("n").alias("n"), mean("s", "c").alias("mean_salary"), mean("sy", "cy").alias("mean_years_exp"),
        mean("sj", "cj").alias("mean_job_sat"),
        (mean("so", "co") if "so" in cells.columns else F.lit(None).cast("double")).alias("mean_org_size"))
    med = grouped_quantiles(b, ["ai_usage_bin"], "salary_usd", [0.5], ["median_salary"], method=quantile_method)
    return null_safe(usage, med, ["ai_usage_bin"], "left").select(
        "ai_usage_bin", "n", _r("mean_salary", 0).alias("mean_salary"), _r("median_salary", 0).alias("median_salary"),
        _r("mean_years_exp", 1).alias("mean_years_exp"), _r("mean_job_sat", 2).alias("mean_job_sat"),
        _r("mean_org_size", 2).alias("mean_org_size")).orderBy("ai_usage_bin")
