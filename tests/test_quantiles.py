import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.operators.quantiles import KEEP, SKETCH, bracketed_quantiles, grouped_quantiles

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(QS))]


def _cmp(a, b):
    assert len(a) == len(b)
    for r1, r2 in zip(a, b):
        for x, y in zip(r1, r2):
            if isinstance(x, float):
                assert abs(x - y) <= 1e-9 * max(1.0, abs(x)), (r1, r2)
            else:
                assert x == y


def test_bracketed_equals_exact_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.choice([None, float(rnd.randint(0, 20)), rnd.random() * 1e6]))
            for _ in range(3000)]
    rows += [("solo", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    ex = sorted(map(tuple, grouped_quantiles(df, ["g"], "x", QS, NAMES, "exact").collect()), key=str)
    for size, keep in ((SKETCH, KEEP), (64, 100)):  # a coarse sketch and little room: brackets are narrowed
        br = sorted(map(tuple, bracketed_quantiles(df, ["g"], "x", QS, NAMES, size, keep).collect()), key=str)
        _cmp(ex, br)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       st.sampled_from([0.1, 0.5, 0.9]))
def test_bracketed_global_property(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    a = grouped_quantiles(df, [], "x", [q], ["v"], "exact").collect()[0][0]
    b = grouped_quantiles(df, [], "x", [q], ["v"], "bracketed").collect()[0][0]
    assert abs(a - b) <= 1e-9 * max(1.0, abs(a))


def test_small_groups_and_interpolated_ranks(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.random() * 1000) for g, n in (("a", 2), ("b", 7), ("c", 400), ("d", 5000)) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = sorted(map(tuple, bracketed_quantiles(df, ["g"], "x", qs, list("abcde")).collect()))
    _cmp(got, sorted(map(tuple, grouped_quantiles(df, ["g"], "x", qs, list("abcde"), "exact").collect())))


@pytest.mark.parametrize("ties", [False, True])
def test_hot_group_is_narrowed_to_a_fixed_number_of_values(spark, monkeypatch, ties):
    """One group holds most rows, with a coarse sketch: several passes narrow its brackets, and no task is
    given more than ``keep`` values, however large the group and whether or not one value fills it."""
    import cohortlens.operators.quantiles as Q

    passes = []
    real = Q.counted

    def spy(src, by, state, targets, collect, size=Q.SKETCH):
        out = real(src, by, state, targets, collect, size)
        if collect:
            passes.append(out.select(*[F.size(f"__v{i}").alias(f"v{i}") for i in range(targets)]).collect())
        else:
            passes.append(None)
        return out

    monkeypatch.setattr(Q, "counted", spy)
    hot = F.when(F.lit(ties) & (F.col("id") % 3 > 0), F.lit(0.5)).otherwise(F.exp(6 * F.rand(3)) / 800)
    df = spark.range(200_000).select(F.when(F.col("id") % 50 == 0, F.concat(F.lit("g"), F.col("id") % 7)).otherwise(F.lit("hot")).alias("g"),
                                     hot.alias("x")).persist()
    qs = [0.1, 0.25, 0.5, 0.75, 0.999]
    got = sorted(map(tuple, bracketed_quantiles(df, ["g"], "x", qs, list("abcde"), size=256, keep=300).collect()))
    _cmp(got, sorted(map(tuple, grouped_quantiles(df, ["g"], "x", qs, list("abcde"), "exact").collect())))
    assert len(passes) >= 3 and passes[-1] is not None
    assert max(v for r in passes[-1] for v in r) <= 300
    if ties:
        assert [r for r in got if r[0] == "hot"][0][3] == 0.5  # the median sits inside the tie block
    df.unpersist()


def test_nan_ranks_above_all_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("a", 3.0), ("b", nan), ("c", None), ("d", -inf), ("d", inf)], "g string, x double")
    for q in (0.0, 0.25, 0.5, 1.0):
        ex, br = (sorted(map(str, grouped_quantiles(df, ["g"], "x", [q], ["v"], m).collect())) for m in ("exact", "bracketed"))
        assert ex == br
    assert grouped_quantiles(df.limit(0), ["g"], "x", [0.5], ["v"], "bracketed").count() == 0
    assert grouped_quantiles(df.limit(0), [], "x", [0.5], ["v"], "bracketed").first()[0] is None


def test_null_group_key_keeps_its_quantiles(spark):
    from cohortlens.operators.summary import Measure, summarize

    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 7.0)], "g string, x double")
    for method in ("exact", "bracketed"):
        got = {r.g: (r.n, r.med) for r in summarize(df, "g", [Measure("n", "count", "x"), Measure("med", "quantile", "x", 2, 0.5)],
                                                    quantile_method=method).collect()}
        assert got == {"a": (2, 1.5), None: (2, 6.0)}


@pytest.mark.parametrize("n", [1, 4, 300, 20_000])
def test_box_stats_equal_the_plain_way_in_three_passes(spark, monkeypatch, n):
    """Trim, quartiles and whiskers from shared sketches equal those of exact percentiles, with ties at the cut,
    groups wholly above it and null values and keys."""
    import cohortlens.operators.figures as figures

    rnd = random.Random(n)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, float(rnd.randint(0, 9)), rnd.lognormvariate(3, 1)])) for _ in range(n)]
    rows += [("top", 1e6 + i % 2) for i in range(n // 60)] + [("cut", 5e5)] * (n // 50)
    df = spark.createDataFrame(rows, "archetype string, x double").repartition(3).persist()
    key = lambda r: str(r[0])
    want = sorted(map(tuple, figures.box_stats(df, "archetype", "x", 0.97, 6, "exact").collect()), key=key)
    made = []
    real = figures.counted
    monkeypatch.setattr(figures, "counted", lambda *a, **k: made.append(1) or real(*a, **k))
    assert sorted(map(tuple, figures.box_stats(df, "archetype", "x", 0.97, 6).collect()), key=key) == want
    assert len(made) == (1 if any(r[1] is not None for r in rows) else 0)  # sketch, counts, whiskers
    monkeypatch.setattr(figures, "KEEP", 1)  # too large for that: cut first, then narrow
    assert sorted(map(tuple, figures.box_stats(df, "archetype", "x", 0.97, 6).collect()), key=key) == want
    df.unpersist()
