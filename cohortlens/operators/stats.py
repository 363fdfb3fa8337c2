"""Correlations and ordinary least squares.

All pairwise Pearson coefficients come from one scan that leaves a matrix of cross-products per task
and null pattern (pairwise-complete).  OLS is
``pyspark.ml`` ``LinearRegression`` with the normal-equation solver: one distributed pass of
cross-products, a p×p solve on the driver, standard errors from the same statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import SIGNIFICANCE_MARKS


def pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """Unordered pairs (i < j) in column order."""
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def round_half_up_scaled(c: Column, scale: int = 1000) -> Column:
    """``floor(c * scale + 0.5) / scale``: ties toward +inf, like ``Math.round``."""
    return F.floor(c * scale + 0.5) / scale


def cross_products(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``present, n, mean, m`` of the rows of each task and null pattern: which columns are there (``0``/``1`` by
    column), how many rows, the columns' means, and the centred cross-products, row by row of their matrix.

    One scan, no shuffle; a task gives one row per null pattern it meets and holds one matrix for each."""
    p = len(cols)

    def merged(old, n, mean, m):
        if old is None:
            return n, mean, m
        n0, mean0, m0 = old
        delta = mean - mean0
        return n0 + n, mean0 + delta * (n / (n0 + n)), m0 + m + np.outer(delta, delta) * (n0 * n / (n0 + n))

    def run(batches):
        held = {}
        for b in batches:
            x = np.stack([c.fill_null(np.nan).to_numpy(zero_copy_only=False) for c in b.columns[:p]], axis=1)
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns[:p]], axis=1)
            patterns, which = np.unique(there, axis=0, return_inverse=True)
            for k, pattern in enumerate(patterns):
                rows = np.where(pattern, x[which.reshape(-1) == k], 0.0)
                d = rows - rows[0]  # a constant column has no spread, to the last bit
                mean = d.mean(axis=0)
                name = "".join("01"[int(v)] for v in pattern)
                held[name] = merged(held.get(name), len(rows), rows[0] + mean, (d - mean).T @ (d - mean))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v[0] for v in held.values()], pa.int64()),
                                              pa.array([v[1].tolist() for v in held.values()]),
                                              pa.array([v[2].ravel().tolist() for v in held.values()])], names=["present", "n", "mean", "m"])

    return df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(
        run, "present string, n long, mean array<double>, m array<double>")


def corr_pairs(df: DataFrame, cols: Sequence[str], digits: int | None = 3) -> DataFrame:
    """``(pair_no, var_a, var_b, pearson_corr)`` for all column pairs, one scan.

    Tasks summarise their rows by null pattern (``cross_products``); a pair's coefficient takes the patterns that
    have both columns (pairwise-complete).  Only summaries are spread over the pairs: their means are brought
    together about the smallest, and cross-products moved to the common mean, which keeps their digits whatever
    the columns' size."""
    ps, p = pairs(cols), len(cols)
    names = F.array(*[F.struct(F.lit(k).alias("pair_no"), F.lit(i).alias("i"), F.lit(j).alias("j"))
                      for k, (i, j) in enumerate((i, j) for i in range(p) for j in range(i + 1, p))])
    one = cross_products(df, cols).select("present", "n", "mean", "m", F.explode(names).alias("e")).select("present", "n", "mean", "m", "e.*")
    at = lambda a, i: F.get(F.col(a), i)
    i, j = F.col("i"), F.col("j")
    one = one.where((F.substring("present", i + 1, F.lit(1)) == "1") & (F.substring("present", j + 1, F.lit(1)) == "1")) \
        .select("pair_no", "n", at("mean", i).alias("a"), at("mean", j).alias("b"),
                at("m", i * p + i).alias("aa"), at("m", j * p + j).alias("bb"), at("m", i * p + j).alias("ab"))
    w = Window.partitionBy("pair_no")  # a row per task and pattern

    def offset(c):  # from the common mean
        low = F.min(c).over(w)
        return F.col(c) - low - F.sum(F.col("n") * (F.col(c) - low)).over(w) / F.sum("n").over(w)

    low = one.withColumns({c: F.col(c) - F.min(c).over(w) for c in "ab"})
    low = low.withColumns({"da": offset("a"), "db": offset("b")})
    sums = low.groupBy("pair_no").agg(*[F.sum(F.col(x + y) + F.col("n") * F.col("d" + x) * F.col("d" + y)).alias(x + y)
                                        for x, y in ("aa", "bb", "ab")])
    long = sums.select("pair_no", F.try_divide("ab", F.sqrt("aa") * F.sqrt("bb")).alias("pearson_corr"))
    if digits is not None:
        long = long.withColumn("pearson_corr", round_half_up_scaled(F.col("pearson_corr"), 10 ** digits))
    # pairs with no complete row still get their (null) row
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ps)],
                                            "pair_no int, var_a string, var_b string")
    return names.join(long, on="pair_no", how="left") \
        .select("pair_no", "var_a", "var_b", "pearson_corr")


def corr_ranked(corr: DataFrame, lead: str) -> DataFrame:
    """Pairs led by ``lead`` first, each block by |r| descending (stable on pair order),
    with the display position as a column."""
    w = Window.orderBy((F.col("var_a") != F.lit(lead)), F.desc(F.abs("pearson_corr")), F.col("pair_no"))
    return corr.withColumn("position", F.row_number().over(w).cast("int")) \
               .select("position", "var_a", "var_b", "pearson_corr")


def corr_matrix(corr: DataFrame, order: Sequence[str]) -> DataFrame:
    """Symmetric wide matrix with unit diagonal, rows and columns in ``order``."""
    spark = corr.sparkSession
    diag = spark.createDataFrame([(c, c, 1.0) for c in order], "var_a string, var_b string, pearson_corr double")
    c = corr.select("var_a", "var_b", "pearson_corr")
    full = c.unionByName(c.select(F.col("var_b").alias("var_a"), F.col("var_a").alias("var_b"),
                                  "pearson_corr")).unionByName(diag)
    wide = full.groupBy("var_a").pivot("var_b", list(order)).agg(F.first("pearson_corr"))
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("var_a"))
    return wide.withColumn("position", pos.cast("int")).withColumnRenamed("var_a", "variable") \
               .select("position", "variable", *list(order)).orderBy("position")


# ---------------------------------------------------------------------------
# OLS
# ---------------------------------------------------------------------------

def fit_ols(df: DataFrame, label: str, features: Sequence[str], prediction_col: str = "salary_predicted",
            features_col: str = "reg_features") -> tuple[LinearRegressionModel, DataFrame]:
    """Fit ``label ~ features`` (intercept, no penalty, normal equations).

    Returns the model and the assembled input (rows with a null input are skipped).
    """
    data = VectorAssembler(inputCols=list(features), outputCol=features_col, handleInvalid="skip") \
        .transform(df).where(F.col(label).isNotNull())
    lr = LinearRegression(featuresCol=features_col, labelCol=label, predictionCol=prediction_col,
                          maxIter=40, regParam=0.0, elasticNetParam=0.0, standardization=True,
                          fitIntercept=True, solver="normal")
    return lr.fit(data), data


def student_p(t: float, freedom: float) -> float:
    """Two-sided p-value of Student's t: the incomplete beta function at ``freedom / (freedom + t**2)``, by its
    continued fraction, so that small values keep their digits."""
    a, x, y = freedom / 2, freedom / (freedom + t * t), t * t / (freedom + t * t)
    if x <= 0 or y <= 0:
        return 1.0 if y <= 0 else 0.0
    # gamma(a + 1/2) / (gamma(a) gamma(1/2)), without the difference of two large logarithms
    ratio = 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) if a > 100 else math.lgamma(a + 0.5) - math.lgamma(a)
    front = math.exp(a * math.log1p(-y) + 0.5 * math.log(y) + ratio) / math.sqrt(math.pi)
    if x > (a + 1) / (a + 2.5):  # beyond the mean: the other tail's fraction converges
        return 1 - front * _beta_fraction(0.5, a, y) / 0.5
    return front * _beta_fraction(a, 0.5, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function for ``x`` below its mean (modified Lentz steps)."""
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for k in range(1, 10_000):
        for term in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d, c = 1 / (1 + term * d), 1 + term / c
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h


def coefficient_table(model: LinearRegressionModel, features: Sequence[str],
                      spark=None, with_intercept: bool = False) -> DataFrame:
    """``(feature, coefficient, std_error, t_stat, p_value)``; p rows (+1 with intercept)."""
    sm = model.summary
    coefs = list(model.coefficients.toArray())
    se, t = list(sm.coefficientStandardErrors), list(sm.tValues)
    p = [student_p(float(v), float(sm.degreesOfFreedom)) for v in t]
    rows = [(f, float(coefs[i]), float(se[i]), float(t[i]), float(p[i])) for i, f in enumerate(features)]
    if with_intercept:
        rows.append(("intercept", float(model.intercept), float(se[-1]), float(t[-1]), float(p[-1])))
    schema = T.StructType([T.StructField("feature", T.StringType())] +
                          [T.StructField(n, T.DoubleType()) for n in ("coefficient", "std_error", "t_stat", "p_value")])
    spark = spark or model.summary.predictions.sparkSession
    return spark.createDataFrame(rows, schema)


def fit_stats(model: LinearRegressionModel, spark=None) -> DataFrame:
    """One row: ``intercept, r2, r2_adj, rmse, n``."""
    sm = model.summary
    spark = spark or sm.predictions.sparkSession
    schema = "intercept double, r2 double, r2_adj double, rmse double, n bigint"
    return spark.createDataFrame([(float(model.intercept), float(sm.r2), float(sm.r2adj),
                                   float(sm.rootMeanSquaredError), int(sm.numInstances))], schema)


def significance(p: Column) -> Column:
    """Stars for a p-value: ``***`` < 0.001, ``**`` < 0.01, ``*`` < 0.05, else ``ns``."""
    expr = None
    for bound, mark in SIGNIFICANCE_MARKS:
        expr = F.when(p < bound, F.lit(mark)) if expr is None else expr.when(p < bound, F.lit(mark))
    return expr.otherwise(F.lit("ns"))


def direction(coef: Column, p: Column, alpha: float = 0.05) -> Column:
    """``negative`` / ``positive`` when significant at ``alpha``, else ``not_significant``."""
    return (F.when((coef < 0) & (p < alpha), F.lit("negative"))
             .when((coef > 0) & (p < alpha), F.lit("positive"))
             .otherwise(F.lit("not_significant")))


def verdict(coef: Column, p: Column) -> Column:
    """Reading of a coefficient that is expected to be negative."""
    return (F.when((coef < 0) & (p < 0.01), F.lit("supported"))
             .when((coef < 0) & (p < 0.05), F.lit("weak support"))
             .when(coef < 0, F.lit("not significant"))
             .otherwise(F.lit("positive: not supported")))


def coefficient_marks(coefs: DataFrame) -> DataFrame:
    """Coefficient table plus ``significance``, ``direction`` and ``verdict`` columns."""
    c, p = F.col("coefficient"), F.col("p_value")
    return coefs.withColumns({"significance": significance(p), "direction": direction(c, p),
                              "verdict": verdict(c, p)})
