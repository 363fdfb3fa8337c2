"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables under ``sf_dir`` (through the respondents view or
directly) over their whole extent.  Float outputs that are compared with the DuckDB oracle
are rounded HALF_UP on a DECIMAL, or to significant digits for fitted statistics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.multivalue import count_items, multi_hot
from ..functions.recode import bucketize, first_item, ordinal_encode, recode_sentinels, round_half_up, round_sig
from ..operators import cluster, crosstab, figures, lloyd, stats
from ..operators.clean import clean_funnel, employed_full_time, in_open_range, select_survey
from ..operators.summary import Measure, summarize
from ..sources.respondents import raw_survey_shape, respondents
from ..sources.tables import read_table
from ..spec import (AI_ACC_LEVELS, AI_SELECT_LEVELS, AI_SENT_LEVELS, AI_THREAT_LEVELS, AI_TOOLS, CLUSTER_FEATURES,
                    CORRELATION_COLUMNS, CORRELATION_DISPLAY_ORDER, EXPERIENCE_BINS, LANGUAGES,
                    ORG_SIZE_LEVELS, OTHER_ANSWER, REGRESSION_FEATURES, REGRESSION_LABEL,
                    SALARY_BOUNDS, SURVEY, UNKNOWN_ROLE, USAGE_BINS, YEARS_SENTINELS)
from . import report, stages

Q = Callable[[SparkSession, str], DataFrame]
Z_DIGITS = 9


# --------------------------------------------------------------------- projections / filters

def q_survey_select(spark, d):
    return select_survey(raw_survey_shape(respondents(spark, d)), SURVEY)


def q_clean(spark, d):
    return stages.clean_table(spark, d)


def q_clean_funnel(spark, d):
    return clean_funnel(respondents(spark, d), SURVEY)


def q_years_recode(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId", "YearsCodePro",
                    recode_sentinels("YearsCodePro", YEARS_SENTINELS).alias("years_code_pro"))


def q_ordinal_orgsize(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId", "OrgSize", ordinal_encode("OrgSize", ORG_SIZE_LEVELS).alias("org_size_int")) \
            .where(F.col("org_size_int").isNotNull())


def q_ordinal_aiselect(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId", "AISelect", ordinal_encode("AISelect", AI_SELECT_LEVELS).alias("ai_select_int")) \
            .where(F.col("ai_select_int").isNotNull())


def q_ordinal_defaults(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId",
                    ordinal_encode("AIAcc", AI_ACC_LEVELS, default=2).alias("ai_acc_int"),
                    ordinal_encode("AIThreat", AI_THREAT_LEVELS, default=0).alias("ai_threat_int"),
                    ordinal_encode("AISent", AI_SENT_LEVELS, default=2).alias("ai_sent_int"))


def q_bin_usage(spark, d):
    f = stages.feature_table(spark, d)
    return f.select("ResponseId", "ai_product_count",
                    bucketize("ai_product_count", USAGE_BINS, closed="right").alias("ai_usage_bin"))


def q_bin_experience(spark, d):
    c = stages.clean_table(spark, d)
    return c.select("ResponseId", "years_code_pro",
                    bucketize("years_code_pro", EXPERIENCE_BINS, closed="left").alias("experience_bin"))


def q_primary_role(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId", first_item("DevType", default=UNKNOWN_ROLE).alias("primary_role"))


def q_filter_employed(spark, d):
    r = respondents(spark, d)
    return r.where(employed_full_time()).select("ResponseId", "Employment")


def q_filter_salary_range(spark, d):
    r = respondents(spark, d)
    lo, hi = SALARY_BOUNDS
    s = r.select("ResponseId", F.col("ConvertedCompYearly").try_cast("double").alias("salary_usd"))
    return s.where(F.col("salary_usd").isNotNull() & in_open_range("salary_usd", lo, hi))


def q_filter_topk_semi(spark, d):
    c = stages.clean_table(spark, d)
    top = crosstab.topk(c, "Country", 5)
    return crosstab.filter_topk(c, "Country", top).select("ResponseId", "Country")


def q_trim_p99(spark, d):
    c = stages.clean_table(spark, d)
    return figures.trim_upper(c, "salary_usd", 0.99).select("ResponseId", "salary_usd")


# --------------------------------------------------------------------- multi-value

def q_mv_count_filtered(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId",
                    count_items("AIBen", drop=[OTHER_ANSWER], drop_empty=True).alias("ai_ben_count"),
                    count_items("AIToolActivities", drop=[OTHER_ANSWER], drop_empty=True).alias("ai_task_count"))


def q_mv_count_raw(spark, d):
    r = respondents(spark, d)
    return r.select("ResponseId", count_items("AIProducts").alias("ai_product_count"))


def q_multi_hot_products(spark, d):
    r = respondents(spark, d).select("ResponseId", "AIProducts")
    return multi_hot(r, "AIProducts", AI_TOOLS, "uses_").drop("AIProducts")


def q_multi_hot_languages(spark, d):
    r = respondents(spark, d).select("ResponseId", "LanguageHaveWorkedWith")
    return multi_hot(r, "LanguageHaveWorkedWith", LANGUAGES, "lang_").drop("LanguageHaveWorkedWith")


def q_mv_explode(spark, d):
    from ..functions.multivalue import explode_items
    return explode_items(respondents(spark, d), "DevType", "dev_role", keep=["ResponseId"])


# --------------------------------------------------------------------- clustering (fixed centres)

def q_zscore_features(spark, d):
    z = stages.z_table(spark, d)
    return z.select("ResponseId", *[round_half_up(c, Z_DIGITS).alias(c) for c in stages.Z_FEATURES])


def _seeded(spark, d):
    return stages.z_table(spark, d), stages.seeded_centres(spark, d)


def q_assign_fixed_centers(spark, d):
    z, centres = _seeded(spark, d)
    return cluster.assign_nearest(z, centres, stages.Z_FEATURES).select("ResponseId", "prediction")


def q_wssse_fixed(spark, d):
    z, centres = _seeded(spark, d)
    w = cluster.wssse(z, centres, stages.Z_FEATURES)
    return w.select(round_sig("wssse", 8).alias("wssse"), "n")


def q_silhouette_fixed(spark, d):
    z, centres = _seeded(spark, d)
    a = cluster.assign_nearest(z, centres, stages.Z_FEATURES)
    return cluster.silhouette(a, stages.Z_FEATURES).select(round_half_up("silhouette", 9).alias("silhouette"))


def q_label_clusters(spark, d):
    _, centres = _seeded(spark, d)
    return cluster.label_table(centres, "z_ai_product_count")


# --------------------------------------------------------------------- cohort tables

def _lab(spark, d):
    return stages.binned_fixed(spark, d)


def q_cluster_sizes(spark, d):
    return report.cluster_sizes(_lab(spark, d))


def q_salary_by_archetype(spark, d):
    return report.salary_by_archetype(_lab(spark, d))


def q_salary_by_archetype_exact(spark, d):
    return report.salary_by_archetype(_lab(spark, d), quantile_method="exact")


def q_jobsat_by_archetype(spark, d):
    return report.jobsat_by_archetype(_lab(spark, d))


def q_ai_tool_adoption(spark, d):
    return report.ai_tool_adoption(_lab(spark, d))


def q_tech_stack(spark, d):
    return report.tech_stack(_lab(spark, d))


def q_profile_by_archetype(spark, d):
    return report.profile_by_archetype(_lab(spark, d))


def q_remote_work_mix(spark, d):
    return report.remote_work_mix(_lab(spark, d))


def q_main_branch_mix(spark, d):
    return report.main_branch_mix(_lab(spark, d))


def q_share_pivot_remote(spark, d):
    return report.remote_work_mix(_lab(spark, d))


def q_primary_role_mix(spark, d):
    return report.role_mix_from_counts(report.role_counts(_lab(spark, d)))[1]


def q_primary_role_mix_scan(spark, d):
    return report.primary_role_mix_long(_lab(spark, d))


def q_primary_role_by_archetype(spark, d):
    return report.primary_role_mix(_lab(spark, d))


def q_topk_roles(spark, d):
    return report.role_mix_from_counts(report.role_counts(_lab(spark, d)))[0]


def q_topk_countries(spark, d):
    return crosstab.topk(stages.clean_table(spark, d), "Country", 5)


def q_summary_by_archetype(spark, d):
    return report.summary_by_archetype(_lab(spark, d))


def q_top_countries(spark, d):
    return report.top_countries(_lab(spark, d))


def q_top_devroles(spark, d):
    return report.top_devroles(_lab(spark, d))


def _deep(spark, d, name):
    cells = stages.shared(spark, d, "cells", lambda: report.deep_cells(_lab(spark, d)))
    return report.deep_dive_tables(_lab(spark, d), with_usage=(name == "deep_salary_by_ai_usage"), cells=cells)[name]


def q_deep_salary_by_usage(spark, d):
    return _deep(spark, d, "deep_salary_by_ai_usage")


def q_salary_by_usage_scan(spark, d):
    return report.salary_by_usage(_lab(spark, d))


def q_salary_exp_x_usage(spark, d):
    return _deep(spark, d, "deep_salary_by_exp_x_ai")


def q_counts_exp_x_usage(spark, d):
    return _deep(spark, d, "deep_counts_by_exp_x_ai")


def q_salary_country_x_usage(spark, d):
    return _deep(spark, d, "deep_salary_by_country_x_ai")


def q_salary_role_x_usage(spark, d):
    return _deep(spark, d, "deep_salary_by_role_x_ai")


def q_pivot_mean_scan(spark, d):
    return report.salary_role_x_usage(_lab(spark, d))


# --------------------------------------------------------------------- statistics

def q_corr_pairs(spark, d):
    return report.correlations(stages.feature_table(spark, d)).drop("pair_no")


def q_corr_ranked(spark, d):
    return stats.corr_ranked(report.correlations(stages.feature_table(spark, d)), "salary_usd")


def q_corr_matrix(spark, d):
    c = stats.corr_pairs(stages.feature_table(spark, d), CORRELATION_COLUMNS, digits=3)
    return stats.corr_matrix(c, CORRELATION_DISPLAY_ORDER)


def _ols(spark, d):
    return stats.fit_ols(stages.feature_table(spark, d), REGRESSION_LABEL, REGRESSION_FEATURES)[0]


def q_ols_coefficients(spark, d):
    coefs = stats.coefficient_table(_ols(spark, d), REGRESSION_FEATURES, spark)
    return coefs.select("feature", *[round_sig(c, 6).alias(c) for c in ("coefficient", "std_error", "t_stat")])


def q_ols_fit_stats(spark, d):
    fs = stats.fit_stats(_ols(spark, d), spark)
    return fs.select(*[round_sig(c, 6).alias(c) for c in ("intercept", "r2", "r2_adj", "rmse")], "n")


def q_ols_fitted(spark, d):
    model, data = stats.fit_ols(stages.feature_table(spark, d), REGRESSION_LABEL, REGRESSION_FEATURES)
    return model.transform(data).select("ResponseId", "salary_usd", round_sig("salary_predicted", 6).alias("salary_predicted"))


def q_ols_marks(spark, d):
    marks = stats.coefficient_marks(stats.coefficient_table(_ols(spark, d), REGRESSION_FEATURES, spark))
    return marks.withColumns({c: round_sig(c, 6) for c in ("coefficient", "std_error", "t_stat", "p_value")})


# --------------------------------------------------------------------- K-Means

def q_kmeans_final(spark, d):
    return report.cluster_sizes(stages.labelled_kmeans(stages.feature_table(spark, d), k=3)[0])


def q_k_sweep(spark, d):
    feats = stages.feature_table(spark, d)
    models = lloyd.fit(feats, range(2, 9), CLUSTER_FEATURES, "ResponseId", max_iter=20)
    return lloyd.sweep_table(feats, models).select(
        "k", round_sig("wssse", 8).alias("wssse"), round_half_up("silhouette", 8).alias("silhouette"),
        round_half_up("delta_cost", 3).alias("delta_cost"))


def q_centroid_heatmap(spark, d):
    _, _, centroids, labels = stages.labelled_kmeans(stages.feature_table(spark, d), k=3)
    return figures.centroid_heatmap(centroids, labels)


# --------------------------------------------------------------------- figure tables

def q_canonical_order(spark, d):
    return figures.in_display_order(q_cluster_sizes(spark, d), "archetype")


def q_headline_outcomes(spark, d):
    ms = [Measure("mean_salary", "mean", "salary_usd", 2), Measure("median_salary", "quantile", "salary_usd", 2, 0.5),
          Measure("mean_job_sat", "mean", "job_sat_int", 3)]
    return figures.in_display_order(summarize(_lab(spark, d), "archetype", ms), "archetype")


def q_simpson_deltas(spark, d):
    return figures.simpson_deltas(_lab(spark, d))


def q_role_heatmap_k(spark, d):
    return figures.role_heatmap_k(q_salary_role_x_usage(spark, d))


def q_country_display(spark, d):
    return figures.country_display(q_salary_country_x_usage(spark, d))


def q_box_stats(spark, d):
    return figures.box_stats(_lab(spark, d), "archetype", "salary_usd", trim_q=0.99)


# --------------------------------------------------------------------- the operators on driver tables

def q_orders_price_summary(spark, d):
    o = read_table(spark, d, "orders")
    ms = [Measure("n", "count", "o_totalprice"), Measure("mean_price", "mean", "o_totalprice", 2),
          Measure("stddev_price", "stddev", "o_totalprice", 2),
          Measure("p25_price", "quantile", "o_totalprice", 2, 0.25),
          Measure("median_price", "quantile", "o_totalprice", 2, 0.5),
          Measure("p75_price", "quantile", "o_totalprice", 2, 0.75)]
    return summarize(o, "o_orderpriority", ms, order=[F.asc("o_orderpriority")])


def q_orders_status_mix(spark, d):
    o = read_table(spark, d, "orders")
    return crosstab.share_pivot(o, "o_orderpriority", "o_orderstatus", ["F", "O", "P"],
                                ["F_pct", "O_pct", "P_pct"])


def q_orders_year_x_priority(spark, d):
    o = read_table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    values = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return crosstab.pivot_mean(o, "o_year", "o_orderpriority", values, "o_totalprice", 2)


def q_lineitem_top_types_per_brand(spark, d):
    """Top part types per brand by line count.  Lines are counted per part key first
    (map-side combined), so a hot part key never reaches the join as many rows."""
    from ..operators.topn import topn_per_group
    per_part = read_table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    p = read_table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    return topn_per_group(j, "p_brand", "p_type", 3, weight="lines")


def q_lineitem_corr(spark, d):
    li = read_table(spark, d, "lineitem")
    return stats.corr_pairs(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], digits=3).drop("pair_no")


def q_lineitem_ols(spark, d):
    li = read_table(spark, d, "lineitem")
    feats = ["l_quantity", "l_discount", "l_tax"]
    model, _ = stats.fit_ols(li, "l_extendedprice", feats, prediction_col="price_predicted")
    coefs = stats.coefficient_table(model, feats, spark)
    return coefs.select("feature", *[round_sig(c, 6).alias(c) for c in ("coefficient", "std_error", "t_stat")])


def q_embeddings_silhouette(spark, d):
    e = read_table(spark, d, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    flat = e.select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    return cluster.silhouette(flat, cols, pred="label").select(round_half_up("silhouette", 9).alias("silhouette"))


def q_embeddings_zscore(spark, d):
    from ..operators.features import zscore
    e = read_table(spark, d, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    flat = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    z = zscore(flat, cols)
    return z.select("vec_id", *[round_half_up("z_" + c, Z_DIGITS).alias("z_" + c) for c in cols])


REGISTRY: dict[str, Q] = {
    "survey_select": q_survey_select,
    "clean": q_clean,
    "clean_funnel": q_clean_funnel,
    "years_recode": q_years_recode,
    "ordinal_orgsize": q_ordinal_orgsize,
    "ordinal_aiselect": q_ordinal_aiselect,
    "ordinal_defaults": q_ordinal_defaults,
    "bin_usage": q_bin_usage,
    "bin_experience": q_bin_experience,
    "primary_role": q_primary_role,
    "filter_employed": q_filter_employed,
    "filter_salary_range": q_filter_salary_range,
    "filter_topk_semi": q_filter_topk_semi,
    "trim_p99": q_trim_p99,
    "mv_count_filtered": q_mv_count_filtered,
    "mv_count_raw": q_mv_count_raw,
    "multi_hot_products": q_multi_hot_products,
    "multi_hot_languages": q_multi_hot_languages,
    "mv_explode": q_mv_explode,
    "zscore_features": q_zscore_features,
    "assign_fixed_centers": q_assign_fixed_centers,
    "wssse_fixed": q_wssse_fixed,
    "silhouette_fixed": q_silhouette_fixed,
    "label_clusters": q_label_clusters,
    "cluster_sizes": q_cluster_sizes,
    "salary_by_archetype": q_salary_by_archetype,
    "salary_by_archetype_exact": q_salary_by_archetype_exact,
    "jobsat_by_archetype": q_jobsat_by_archetype,
    "ai_tool_adoption": q_ai_tool_adoption,
    "tech_stack": q_tech_stack,
    "profile_by_archetype": q_profile_by_archetype,
    "remote_work_mix": q_remote_work_mix,
    "main_branch_mix": q_main_branch_mix,
    "share_pivot_remote": q_share_pivot_remote,
    "primary_role_mix": q_primary_role_mix,
    "primary_role_mix_scan": q_primary_role_mix_scan,
    "primary_role_by_archetype": q_primary_role_by_archetype,
    "topk_roles": q_topk_roles,
    "topk_countries": q_topk_countries,
    "summary_by_archetype": q_summary_by_archetype,
    "top_countries": q_top_countries,
    "top_devroles": q_top_devroles,
    "deep_salary_by_usage": q_deep_salary_by_usage,
    "salary_by_usage_scan": q_salary_by_usage_scan,
    "salary_exp_x_usage": q_salary_exp_x_usage,
    "counts_exp_x_usage": q_counts_exp_x_usage,
    "salary_country_x_usage": q_salary_country_x_usage,
    "salary_role_x_usage": q_salary_role_x_usage,
    "pivot_mean_scan": q_pivot_mean_scan,
    "corr_pairs": q_corr_pairs,
    "corr_ranked": q_corr_ranked,
    "corr_matrix": q_corr_matrix,
    "ols_coefficients": q_ols_coefficients,
    "ols_fit_stats": q_ols_fit_stats,
    "ols_marks": q_ols_marks,
    "ols_fitted": q_ols_fitted,
    "kmeans_final": q_kmeans_final,
    "k_sweep": q_k_sweep,
    "centroid_heatmap": q_centroid_heatmap,
    "canonical_order": q_canonical_order,
    "headline_outcomes": q_headline_outcomes,
    "simpson_deltas": q_simpson_deltas,
    "role_heatmap_k": q_role_heatmap_k,
    "country_display": q_country_display,
    "box_stats": q_box_stats,
    "orders_price_summary": q_orders_price_summary,
    "orders_status_mix": q_orders_status_mix,
    "orders_year_x_priority": q_orders_year_x_priority,
    "lineitem_top_types_per_brand": q_lineitem_top_types_per_brand,
    "lineitem_corr": q_lineitem_corr,
    "lineitem_ols": q_lineitem_ols,
    "embeddings_silhouette": q_embeddings_silhouette,
    "embeddings_zscore": q_embeddings_zscore,
}
