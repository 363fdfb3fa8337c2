"""Report tables: the shared-scan path equals the one-scan-per-table path; invariants."""

from pyspark.sql import functions as F

from cohortlens.plans import report, stages


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shared_profile_equals_separate_tables(spark, sf_dir):
    lab = stages.binned_fixed(spark, sf_dir)
    shared = report.impact_report(lab, quantile_method="bracketed")
    separate = report.impact_report_separate(lab, quantile_method="exact")
    assert list(shared) == list(separate)
    for name in shared:
        a, b = shared[name], separate[name]
        assert a.columns == b.columns, name
        assert _rows(a) == _rows(b), name


def test_deep_dive_cells_equal_direct_pivots(spark, sf_dir):
    b = stages.binned_fixed(spark, sf_dir)
    t = report.deep_dive_tables(b)
    assert _rows(t["deep_salary_by_exp_x_ai"]) == _rows(report.salary_exp_x_usage(b))
    assert _rows(t["deep_counts_by_exp_x_ai"]) == _rows(report.counts_exp_x_usage(b))
    assert _rows(t["deep_salary_by_country_x_ai"]) == _rows(report.salary_country_x_usage(b))
    assert _rows(t["deep_salary_by_role_x_ai"]) == _rows(report.salary_role_x_usage(b))


def test_share_rows_sum_to_at_most_100(spark, sf_dir):
    lab = stages.binned_fixed(spark, sf_dir)
    t = report.impact_report(lab)
    for name in ("remote_work_by_archetype", "main_branch_by_archetype", "primary_role_by_archetype"):
        df = t[name]
        pcts = [c for c in df.columns if c.endswith("_pct")]
        for r in df.collect():  # each share is rounded to 0.1: at most 0.05 error per column
            assert sum(r[c] for c in pcts) <= 100.0 + 0.05 * len(pcts) + 1e-9, (name, r)


def test_quartiles_ordered_and_sizes_sum(spark, sf_dir):
    lab = stages.binned_fixed(spark, sf_dir)
    t = report.impact_report(lab)
    for r in t["salary_by_archetype"].collect():
        assert r.p25_salary <= r.median_salary <= r.p75_salary
    assert sum(r["count"] for r in t["cluster_sizes"].collect()) == lab.count()
    tops = t["top_countries_by_archetype"].groupBy("archetype").count().collect()
    assert all(r["count"] <= 5 for r in tops)


def test_topn_ties_break_by_value(spark):
    from cohortlens.operators.topn import topn_per_group
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("a", "z"), ("b", None)], "g string, v string")
    got = [tuple(r) for r in topn_per_group(df, "g", "v", 2).collect()]
    assert got == [("a", "z", 2), ("a", "x", 1)]


def test_share_pivot_denominators(spark):
    from cohortlens.operators.crosstab import share_pivot
    df = spark.createDataFrame([("a", "R"), ("a", "H"), ("a", "other"), ("a", None), ("b", None)], "g string, c string")
    nn = {r.g: tuple(r)[1:] for r in share_pivot(df, "g", "c", ["R", "H"]).collect()}
    assert nn == {"a": (3, 33.3, 33.3)}  # group b has no non-null cell: absent
    al = {r.g: tuple(r)[1:] for r in share_pivot(df, "g", "c", ["R", "H"], denom="all").collect()}
    assert al == {"a": (4, 25.0, 25.0), "b": (1, 0.0, 0.0)}
    inner = {r.g for r in share_pivot(df, "g", "c", ["R", "H"], denom="all", require_match=True).collect()}
    assert inner == {"a"}


def test_pivot_count_empty_cell_is_null(spark):
    from cohortlens.operators.crosstab import pivot_count
    df = spark.createDataFrame([("x", "u1"), ("y", "u2")], "r string, c string")
    got = {r.r: (r.u1, r.u2) for r in pivot_count(df, "r", "c", ["u1", "u2"]).collect()}
    assert got == {"x": (1, None), "y": (None, 1)}


def test_pivot_values_with_dots_and_commas(spark):
    from cohortlens.functions.recode import role_column_name
    from cohortlens.operators.crosstab import pivot_mean, share_long, share_wide, topk
    df = spark.createDataFrame([("a", "Developer, .NET", 10.0), ("a", "x.y (z)", 20.0), ("b", "x.y (z)", 30.0)],
                               "g string, r string, v double")
    long = share_long(df, "g", "r", topk(df, "r", 5))
    roles = ["Developer, .NET", "x.y (z)"]
    wide = {r.g: r.asDict() for r in share_wide(long, "g", "r", roles, [role_column_name(x) for x in roles]).collect()}
    assert wide["a"]["dev_NET_pct"] == 50.0 and wide["b"]["x_y_z_pct"] == 100.0 and wide["b"]["dev_NET_pct"] == 0.0
    pm = {r.g: r.asDict() for r in pivot_mean(df, "g", "r", roles, "v").collect()}
    assert pm["a"]["x.y (z)"] == 20.0 and pm["b"]["Developer, .NET"] is None


def test_ordered_by_fixed_order(spark):
    from cohortlens.operators.crosstab import ordered_by
    from cohortlens.operators.figures import in_display_order
    df = spark.createDataFrame([("AI Power User",), ("zeta",), ("Traditional Engineer",), ("AI Experimenter",), ("alpha",)],
                               "archetype string")
    assert [r[0] for r in ordered_by(df, "archetype", ["Traditional Engineer", "AI Experimenter", "AI Power User"]).collect()] == \
        ["Traditional Engineer", "AI Experimenter", "AI Power User", "alpha", "zeta"]
    got = [(r.archetype, r.position) for r in in_display_order(df, "archetype").collect()]
    assert got[:3] == [("Traditional Engineer", 1), ("AI Experimenter", 2), ("AI Power User", 3)]
    assert got[3:] == [("alpha", None), ("zeta", None)]
