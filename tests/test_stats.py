"""Correlations and OLS against NumPy closed forms."""

import math
import random

import numpy as np

from cohortlens.operators import stats


def _data(spark, n=400, seed=11):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        x1, x2, x3 = rnd.gauss(0, 1), rnd.randint(0, 10), rnd.random()
        y = 3.0 + 2.0 * x1 - 0.5 * x2 + 4.0 * x3 + rnd.gauss(0, 1)
        rows.append((x1, float(x2), x3, y, 1.0))
    return spark.createDataFrame(rows, "x1 double, x2 double, x3 double, y double, const double"), np.array(rows)


def test_corr_pairs_match_numpy_and_are_symmetric(spark):
    df, a = _data(spark)
    cols = ["x1", "x2", "x3", "y"]
    got = {(r.var_a, r.var_b): r.pearson_corr for r in stats.corr_pairs(df, cols, digits=None).collect()}
    m = np.corrcoef(a[:, :4].T)
    for i in range(4):
        for j in range(i + 1, 4):
            assert math.isclose(got[(cols[i], cols[j])], m[i, j], rel_tol=1e-9, abs_tol=1e-12)
    mat = stats.corr_matrix(stats.corr_pairs(df, cols), cols).collect()
    for r in mat:
        for c in cols:
            other = [x for x in mat if x.variable == c][0]
            assert r[c] == other[r.variable]
        assert r[r.variable] == 1.0


def test_corr_constant_column_is_null_not_error(spark):
    df, _ = _data(spark)
    got = stats.corr_pairs(df, ["x1", "const"]).collect()[0]
    assert got.pearson_corr is None


def test_corr_pairwise_complete_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 1.0), (None, 3.0)], "a double, b double")
    got = stats.corr_pairs(df, ["a", "b"], digits=None).collect()[0].pearson_corr
    from pyspark.sql import functions as F
    ref = df.agg(F.corr("a", "b")).collect()[0][0]
    assert math.isclose(got, ref, rel_tol=1e-12)


def test_corr_patterns_sizes_and_offsets(spark):
    """Every null pattern, columns far from zero, many tasks: pairwise-complete coefficients of NumPy."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 4)) @ rng.standard_normal((4, 4)) + [0, 1e9, -5e6, 3]
    gone = rng.random(x.shape) < [.3, .1, .5, 0]
    rows = [(*[None if g else float(v) for v, g in zip(r, m)], 7.1, None) for r, m in zip(x, gone)]
    cols = list("abcd") + ["same", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(9)
    got = {(r.var_a, r.var_b): r.pearson_corr for r in stats.corr_pairs(df, cols, digits=None).collect()}
    assert len(got) == 15
    for i in range(4):
        assert got[cols[i], "same"] is None and got[cols[i], "none"] is None
        for j in range(i + 1, 4):
            both = ~gone[:, i] & ~gone[:, j]
            assert math.isclose(got[cols[i], cols[j]], np.corrcoef(x[both, i], x[both, j])[0, 1], rel_tol=1e-6, abs_tol=1e-9)
    assert [r.pearson_corr for r in stats.corr_pairs(df.limit(0), ["a", "b"]).collect()] == [None]


def test_corr_summarises_rows_instead_of_multiplying_them(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(*[(F.col("id") % (k + 2)).cast("double").alias(f"c{k}") for k in range(6)])
    parts = stats.cross_products(df.repartition(3), [f"c{k}" for k in range(6)]).collect()
    assert len(parts) == 3 and sum(r.n for r in parts) == 5000  # a row per task and null pattern
    plan = stats.corr_pairs(df, [f"c{k}" for k in range(6)])._jdf.queryExecution().optimizedPlan().toString()
    assert "stack" not in plan and plan.count("MapInArrow") == 1


def test_student_p_values():
    """Closed forms for 1 and 2 degrees of freedom, the normal tail for many, and no loss in the far tail."""
    for t in (0.0, 0.1, 0.9, 1.7, 3.0, 40.0, -2.0):
        assert math.isclose(stats.student_p(t, 1), 1 - 2 * math.atan(abs(t)) / math.pi, rel_tol=1e-11, abs_tol=1e-13)
        assert math.isclose(stats.student_p(t, 2), 1 - abs(t) / math.sqrt(2 + t * t), rel_tol=1e-10, abs_tol=1e-13)
    for t in (0.5, 1.96, 5.0):
        assert math.isclose(stats.student_p(t, 1e9), math.erfc(t / math.sqrt(2)), rel_tol=1e-6)
    assert 0 < stats.student_p(30.0, 13547) < 1e-150 and stats.student_p(1e6, 13547) == 0.0


def test_ols_matches_normal_equations(spark):
    df, a = _data(spark)
    feats = ["x1", "x2", "x3"]
    model, _ = stats.fit_ols(df, "y", feats, prediction_col="yhat")
    X = np.column_stack([a[:, 0:3], np.ones(len(a))])
    y = a[:, 3]
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    n, p = X.shape
    sigma2 = resid @ resid / (n - p)
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * sigma2)
    coefs = stats.coefficient_table(model, feats, spark, with_intercept=True).collect()
    for i, r in enumerate(coefs):
        assert math.isclose(r.coefficient, beta[i], rel_tol=1e-7)
        assert math.isclose(r.std_error, se[i], rel_tol=1e-6)
        assert math.isclose(r.t_stat, beta[i] / se[i], rel_tol=1e-6)
        # large dof: the t tail is close to the normal tail
        p_norm = math.erfc(abs(beta[i] / se[i]) / math.sqrt(2))
        assert 0.0 <= r.p_value <= 1.0
        if p_norm > 1e-6:
            assert math.isclose(r.p_value, p_norm, rel_tol=0.05)
    fs = stats.fit_stats(model, spark).collect()[0]
    r2 = 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean()))
    assert math.isclose(fs.r2, r2, rel_tol=1e-9) and fs.n == n
    assert math.isclose(fs.rmse, math.sqrt(resid @ resid / n), rel_tol=1e-9)


def test_significance_direction_verdict(spark):
    df = spark.createDataFrame([(-1.0, 0.0005), (-1.0, 0.02), (-1.0, 0.2), (2.0, 0.0001), (0.0, 0.5), (-1.0, 0.005)],
                               "coefficient double, p_value double")
    got = [tuple(r)[2:] for r in stats.coefficient_marks(df).collect()]
    assert got == [("***", "negative", "supported"), ("*", "negative", "weak support"),
                   ("ns", "not_significant", "not significant"), ("***", "positive", "positive: not supported"),
                   ("ns", "not_significant", "positive: not supported"), ("**", "negative", "supported")]
