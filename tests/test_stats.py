"""Test statistics and p-values: identities, printed tables, brute force, edge samples."""

import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sentiseries.functions import pvalues as P
from sentiseries.functions.normal import with_normal_quantile
from sentiseries.stats import order, shapiro
from sentiseries.stats.chi2 import chi2_independence
from sentiseries.stats.levene import levene
from sentiseries.stats.moments import (
    anova_oneway, cohens_d, dagostino_k2, ttest_student, ttest_welch,
)
from sentiseries.stats.ranks import kruskal_wallis, mann_whitney
from sentiseries.stats.shapiro import shapiro_wilk


def frame(spark, **samples):
    """Samples of one variable as (variable, period, value) rows."""
    rows = [("x", name, float(v)) for name, values in samples.items() for v in values]
    return spark.createDataFrame(rows, "variable string, period string, value double")


@pytest.fixture(scope="module")
def two(spark):
    rng = random.Random(3)
    return frame(
        spark,
        before=[round(rng.gauss(0, 1), 3) for _ in range(31)],
        after=[round(rng.gauss(0.6, 1.7), 3) for _ in range(24)],
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


# Critical values as printed in standard tables: (statistic, degrees of freedom) at p.

@pytest.mark.parametrize("x, dof, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (135.806723, 100, 0.01)])
def test_chi2_table(x, dof, p):
    assert P.chi2_upper(x, dof) == pytest.approx(p, abs=1e-7)


@pytest.mark.parametrize("t, dof, p", [(12.7062047, 1, 0.05), (2.2281389, 10, 0.05), (2.617421, 120, 0.01), (1.9599640, 1e8, 0.05)])
def test_t_table(t, dof, p):
    assert P.t_two_sided(t, dof) == pytest.approx(p, abs=2e-6)


@pytest.mark.parametrize("f, d1, d2, p", [(4.9646027, 1, 10, 0.05), (3.3258345, 5, 10, 0.05), (161.4476, 1, 1, 0.05)])
def test_f_table(f, d1, d2, p):
    assert P.f_upper(f, d1, d2) == pytest.approx(p, abs=1e-6)


def test_even_chi2_is_closed_form():
    for x in (0.1, 2.0, 40.0):
        assert P.chi2_upper(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)


def test_exact_rank_sum_against_all_deals():
    for n1, n2 in ((1, 1), (2, 5), (4, 4), (5, 3)):
        ranks = range(1, n1 + n2 + 1)
        us = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(ranks, n1)]
        for u in set(us):
            tail = sum(v <= min(u, n1 * n2 - u) for v in us) / len(us)
            assert P.rank_sum_exact(u, n1, n2) == pytest.approx(min(1.0, 2 * tail))


def test_normal_quantile(spark):
    df = spark.range(1, 2000).select((F.col("id") / 2000).alias("p")).union(
        spark.createDataFrame([(1e-12,), (1e-30,), (1 - 1e-9,)], "p double")
    )
    for row in with_normal_quantile(df, F.col("p"), "z").collect():
        assert row["z"] == pytest.approx(statistics.NormalDist().inv_cdf(row["p"]), rel=1e-12, abs=1e-12)


# Positions.

def brute_positions(values):
    return {v: (sum(w < v for w in values), values.count(v), len(values)) for v in values}


@pytest.fixture
def settings(spark):
    """Sets session settings for one test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_positions_with_any_slicing(spark, settings, partitions):
    settings(shuffle__partitions=str(partitions), adaptive__coalescePartitions__enabled="false")
    rng = random.Random(partitions)
    groups = {"a": [float(rng.randrange(60)) for _ in range(400)], "b": [rng.random() for _ in range(90)], "c": [1.0]}
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, value double")
    placed = order.with_positions(order.value_counts(df, ["g"]), ["g"]).collect()
    got = {(r["g"], r["value"]): (r["before"], r["ties"], r["n"]) for r in placed}
    want = {(g, v): p for g, values in groups.items() for v, p in brute_positions(values).items()}
    assert got == want


def test_exact_median(spark):
    rng = random.Random(9)
    groups = {g: [float(rng.randrange(20)) for _ in range(n)] for g, n in (("odd", 31), ("even", 40), ("one", 1))}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, value double")
    got = {r["g"]: r["median"] for r in order.exact_median(df, ["g"]).collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}


# Identities between tests.

def test_student_squared_is_the_f_ratio(two):
    t, f = one(ttest_student(two)), one(anova_oneway(two, group="period"))
    assert t["statistic"] ** 2 == pytest.approx(f["statistic"])
    assert t["p_value"] == pytest.approx(f["p_value"])


def test_kruskal_with_two_groups_is_the_uncorrected_rank_test(two):
    h, u = one(kruskal_wallis(two, group="period")), one(mann_whitney(two))
    values = [r["value"] for r in two.collect()]
    n1, n2, n = 31, 24, 55
    ties = sum(t**3 - t for _, t, _ in brute_positions(values).values())
    variance = n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))
    assert h["statistic"] == pytest.approx((u["statistic"] - n1 * n2 / 2) ** 2 / variance)


def test_both_u_add_up(two):
    first = one(mann_whitney(two))["statistic"]
    second = one(mann_whitney(two, pair=("after", "before")))["statistic"]
    assert first + second == 31 * 24


def test_welch_equals_student_for_equal_sizes_and_spread(spark):
    df = frame(spark, before=[1, 2, 3, 4], after=[3, 4, 5, 6])
    w, s = one(ttest_welch(df)), one(ttest_student(df))
    assert w["statistic"] == pytest.approx(s["statistic"]) and w["df1"] == pytest.approx(s["df1"])


def test_effect_size_sign_is_before_minus_after(spark):
    row = one(cohens_d(frame(spark, before=[1, 2, 3], after=[4, 5, 6])))
    assert row["statistic"] == pytest.approx(-3.0)


# Worked examples.

def test_small_rank_test_is_exact(spark):
    row = one(mann_whitney(frame(spark, before=[1, 2, 3], after=[4, 5, 6])))
    assert row["statistic"] == 0 and row["p_value"] == pytest.approx(0.1)


def test_small_tied_rank_test_is_approximate(spark):
    row = one(mann_whitney(frame(spark, before=[1, 2, 2], after=[2, 5, 6])))
    assert row["statistic"] == 1.0
    z = (abs(1.0 - 4.5) - 0.5) / math.sqrt(9 / 12 * (7 - 24 / 30))
    assert row["p_value"] == pytest.approx(P.normal_two_sided(z))


def test_levene_by_hand(spark):
    df = frame(spark, before=[1, 2, 3, 10], after=[4, 4, 5, 5, 6])
    groups = [[abs(v - 2.5) for v in (1, 2, 3, 10)], [abs(v - 5) for v in (4, 4, 5, 5, 6)]]
    flat = [d for g in groups for d in g]
    between = sum(len(g) * (statistics.mean(g) - statistics.mean(flat)) ** 2 for g in groups)
    within = sum((d - statistics.mean(g)) ** 2 for g in groups for d in g)
    row = one(levene(df))
    assert row["statistic"] == pytest.approx(between / (within / 7))
    assert row["p_value"] == pytest.approx(P.f_upper(row["statistic"], 1, 7))


def test_shapiro_published_example(spark):
    # Weights of eleven men, the example of the 1965 paper; W = 0.79.
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    row = one(shapiro_wilk(frame(spark, before=weights)))
    assert row["statistic"] == pytest.approx(0.79, abs=0.005)
    assert 0.005 < row["p_value"] < 0.01


def test_shapiro_of_three_is_exact(spark):
    row = one(shapiro_wilk(frame(spark, before=[0, 1, 3])))
    w = (3 * math.sqrt(0.5)) ** 2 / sum((v - 4 / 3) ** 2 for v in (0, 1, 3))
    assert row["statistic"] == pytest.approx(w)
    assert row["p_value"] == pytest.approx(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))


@pytest.mark.parametrize("ties", [(25, 40), (300, 1), (5000, 3), (64, 700)])
def test_shapiro_sums_runs_as_it_would_sum_positions(spark, monkeypatch, ties):
    from sentiseries.stats import shapiro

    values = [1.0] * ties[0] + [2.5] * ties[1] + [float(v) * v for v in range(3, 200)] + [-4.0] * 150
    by_runs = one(shapiro_wilk(frame(spark, before=values)))
    monkeypatch.setattr(shapiro, "EDGE", 10**9)
    by_positions = one(shapiro_wilk(frame(spark, before=values)))
    for name in ("statistic", "p_value"):
        assert math.isclose(by_runs[name], by_positions[name], rel_tol=1e-9, abs_tol=1e-300)


def test_shapiro_of_very_many_ties_needs_few_rows(spark):
    from sentiseries.stats import shapiro

    placed = spark.createDataFrame([("v", 1.0, 10_000_000, 0, 20_000_000), ("v", 2.0, 10_000_000, 10_000_000, 20_000_000)], "variable string, value double, ties long, before long, n long")
    assert shapiro._runs(placed).count() < 10_000
    sums = shapiro._with_run_sums(shapiro._runs(placed)).selectExpr("sum(scores)", "sum(score_squares) / 2e7", "sum(hi - lo + 1)").first()
    assert abs(sums[0]) < 1e-3 and abs(sums[1] - 1) < 1e-5 and sums[2] == 20_000_000


def test_k2_rejects_a_skewed_sample_and_is_closed_form(spark):
    row = one(dagostino_k2(frame(spark, before=[math.exp(i / 8) for i in range(60)])))
    assert row["p_value"] == pytest.approx(math.exp(-row["statistic"] / 2)) and not row["keep_null"]


def table_frame(spark, counts):
    rows = [("x", a, b) for (a, b), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "variable string, a string, b string")


def test_two_by_two_gets_the_continuity_correction(spark):
    row = one(chi2_independence(table_frame(spark, {("p", "q"): 12, ("p", "r"): 5, ("s", "q"): 3, ("s", "r"): 9}), "a", "b"))
    n, det = 29, abs(12 * 9 - 5 * 3)
    assert row["statistic"] == pytest.approx(n * (det - n / 2) ** 2 / (17 * 12 * 15 * 14))
    assert row["df1"] == 1


def test_empty_cells_count_in_larger_tables(spark):
    counts = {("p", "q"): 8, ("p", "r"): 1, ("s", "r"): 6, ("t", "q"): 4, ("t", "r"): 4}
    row = one(chi2_independence(table_frame(spark, counts), "a", "b"))
    rows, columns = {"p": 9, "s": 6, "t": 8}, {"q": 12, "r": 11}
    want = sum((counts.get((a, b), 0) - ra * cb / 23) ** 2 / (ra * cb / 23) for a, ra in rows.items() for b, cb in columns.items())
    assert row["statistic"] == pytest.approx(want) and row["df1"] == 2


# Samples no statistic exists for.

EVERY = [
    ("k2", lambda df: dagostino_k2(df)), ("shapiro", lambda df: shapiro_wilk(df)),
    ("student", lambda df: ttest_student(df)), ("welch", lambda df: ttest_welch(df)),
    ("cohen", lambda df: cohens_d(df)), ("anova", lambda df: anova_oneway(df, group="period")),
    ("levene", lambda df: levene(df)), ("rank", lambda df: mann_whitney(df)),
    ("kruskal", lambda df: kruskal_wallis(df, group="period")),
]


@pytest.mark.parametrize("name, test", EVERY)
def test_constant_samples_give_null(spark, name, test):
    row = one(test(frame(spark, before=[2] * 12, after=[2] * 12)))
    assert name == "rank" or row["statistic"] is None
    assert row["p_value"] is None and row["keep_null"] is None


@pytest.mark.parametrize("name, test", EVERY)
def test_one_value_gives_null(spark, name, test):
    row = one(test(frame(spark, before=[2.0])))
    assert row["statistic"] is None and row["p_value"] is None


def test_nulls_and_nan_are_left_out(spark):
    df = spark.createDataFrame(
        [("x", "before", v) for v in (1.0, 2.0, 4.0, None, float("nan"))]
        + [("x", "after", v) for v in (2.0, 5.0, None)],
        "variable string, period string, value double",
    )
    row = one(ttest_student(df))
    assert (row["n1"], row["n2"]) == (3, 2)
    assert one(levene(df))["n1"] == 5


# Digits, bounds and hot values.

def test_f_ratio_keeps_its_digits_beside_a_large_offset(spark):
    """Groups around 1e6 with a spread of 1e-3, against the sums done in exact numbers."""
    from fractions import Fraction

    rng = random.Random(3)
    rows = [(g, 1e6 + rng.gauss(0, 1e-3) + (1e-5 if g == "b" else 0)) for g in "abc" for _ in range(4000)]
    groups = {g: [Fraction(v) for h, v in rows if h == g] for g in "abc"}
    means = {g: sum(v) / len(v) for g, v in groups.items()}
    middle = sum(sum(v) for v in groups.values()) / len(rows)
    between = sum(len(v) * (means[g] - middle) ** 2 for g, v in groups.items()) / 2
    within = sum((x - means[g]) ** 2 for g, v in groups.items() for x in v) / (len(rows) - 3)
    df = spark.createDataFrame(rows, "subreddit string, value double").withColumn("variable", F.lit("v"))
    assert one(anova_oneway(df))["statistic"] == pytest.approx(float(between / within), rel=1e-4)


def test_levene_meets_a_brute_force(spark):
    rng = random.Random(4)
    groups = {g: [round(rng.gauss(0, s), 1) for _ in range(n)] for g, s, n in (("a", 1, 60), ("b", 3, 41), ("c", 1, 7))}
    gaps = {g: [abs(x - statistics.median(v)) for x in v] for g, v in groups.items()}
    every = [x for v in gaps.values() for x in v]
    between = sum(len(v) * (statistics.fmean(v) - statistics.fmean(every)) ** 2 for v in gaps.values()) / 2
    within = sum((x - statistics.fmean(v)) ** 2 for v in gaps.values() for x in v) / (len(every) - 3)
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "subreddit string, value double")
    got = one(levene(df.withColumn("variable", F.lit("v")), group="subreddit"))
    assert got["statistic"] == pytest.approx(between / within) and (got["n1"], got["n2"]) == (len(every), 3)


def test_tails_for_many_degrees_of_freedom():
    assert P.f_upper(1, 4, 1e12) == pytest.approx(P.chi2_upper(4, 4), rel=1e-8)
    for dof in (1e3, 1e6, 1e9, 1e12):
        assert P.f_upper(1, dof, dof) == pytest.approx(0.5, rel=1e-8)
        assert P.f_upper(1.0001, dof, dof / 3) + P.f_upper(1 / 1.0001, dof / 3, dof) == pytest.approx(1, rel=1e-8)
    for t in (0.1, 1.96, 6.0):
        assert P.t_two_sided(t, 1e12) == pytest.approx(P.normal_two_sided(t), rel=1e-8)
    # both ways to a probability meet where one takes over from the other
    for a in (0.999e8, 1.001e8):
        z = 1.5 / math.sqrt(2 * a) / 2
        assert P.beta_lower(0.5 - z / 2, a, a) == pytest.approx(P.normal_upper(z / 2 * math.sqrt(8 * a)), rel=1e-6)


def test_a_fraction_that_does_not_settle_has_no_value(monkeypatch):
    monkeypatch.setattr(P, "_MOST_TERMS", 3)
    assert math.isnan(P.f_upper(1.3, 1e5, 1e5))


def test_exact_rank_sum_is_bounded():
    # one value against many: every place is as likely
    assert P.rank_sum_exact(25, 1, 10**9) == pytest.approx(2 * 26 / (10**9 + 1))
    assert P.rank_sum_exact(4e9, 8, 10**9) == pytest.approx(1.0, rel=1e-6)
    assert 0.1 < P.rank_sum_exact(3e6, 8, 10**6) < 0.5
    assert 0 < P.rank_sum_exact(9e7, 10**4, 10**4 * 2) < 1e-30
    assert math.isnan(P.rank_sum_exact(1e13, 2 * 10**6, 10**7))


def test_rank_sum_methods(two):
    exact, plain = (one(mann_whitney(two, method=m)) for m in ("exact", "asymptotic"))
    assert exact["statistic"] == plain["statistic"] and exact["p_value"] == pytest.approx(plain["p_value"], abs=0.05)
    with pytest.raises(ValueError):
        mann_whitney(two, method="other")


def test_a_frequent_value_takes_few_rows(spark):
    rows = spark.range(1_000_000).select(F.lit("v").alias("variable"), F.lit(1.0).alias("value"))
    rows = rows.union(spark.createDataFrame([("v", float(i)) for i in range(50)], "variable string, value double"))
    placed = order.placed_samples(rows, ["variable"])
    assert shapiro._runs(placed).count() < 50 + 2 * shapiro.EDGE


def test_integrated_rank_sum_equals_the_listed_one():
    """The circle against the counts themselves, in the middle and far out in the tail."""
    for few, many, reaches in ((12, 2000, (60, 3000, 11900)), (30, 900, (400, 9000, 13400)), (200, 220, (5000, 21900))):
        for reach in reaches:
            listed = P.rank_sum_exact(reach, few, many)
            assert min(1.0, 2 * P._rank_sum_tail(reach, few, many)) == pytest.approx(listed, rel=1e-9)


def test_integrated_rank_sum_of_large_samples():
    """Against the normal tail with the term of U's fourth cumulant."""
    few, many = 5000, 40_000
    middle, spread = few * many / 2, math.sqrt(few * many * (few + many + 1) / 12)
    excess = -1.2 * (few**2 + many**2 + few * many + few + many) / (few * many * (few + many + 1))
    for wanted in (0.5, 2.0, 4.0):
        reach = math.ceil(middle - wanted * spread)
        z = (middle - reach - 0.5) / spread
        density = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        tail = P.normal_two_sided(z) + 2 * density * excess / 24 * (z**3 - 3 * z)
        assert P.rank_sum_exact(reach, few, many) == pytest.approx(tail, rel=1e-5)
    assert P.rank_sum_exact(middle, few, many) == pytest.approx(1.0, abs=1e-4)
