"""Tests that need only counts, means, variances and higher moments.

Every function takes samples in long form (one value per row, the test's keys in
columns) and runs all keys at once. The moments merge, so each map task sends one
row per key and a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentiseries.functions.pvalues import f_p, t_p
from sentiseries.stats.results import DEFAULT_ALPHA, observed, results

PERIODS = ("before", "after")


def _two_samples(
    samples: DataFrame, keys: Sequence[str], sample: str, pair: tuple[str, str]
) -> DataFrame:
    def side(name: str) -> Column:
        return F.when(F.col(sample) == name, F.col("value"))

    first, second = (side(name) for name in pair)
    return observed(samples).groupBy(*keys).agg(
        F.count(first).alias("n1"), F.count(second).alias("n2"),
        F.avg(first).alias("mean1"), F.avg(second).alias("mean2"),
        F.var_samp(first).alias("var1"), F.var_samp(second).alias("var2"),
    )


def _pooled_variance() -> Column:
    within = (F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2")
    return F.try_divide(within, F.col("n1") + F.col("n2") - 2)


def ttest_student(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    sample: str = "period",
    pair: tuple[str, str] = PERIODS,
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """Two-sample t test with equal variances, two-sided."""
    m = _two_samples(samples, keys, sample, pair)
    error = F.sqrt(_pooled_variance() * (F.try_divide(F.lit(1.0), F.col("n1")) + F.try_divide(F.lit(1.0), F.col("n2"))))
    m = m.withColumn("t", F.try_divide(F.col("mean1") - F.col("mean2"), error))
    dof = (F.col("n1") + F.col("n2") - 2).cast("double")
    return results(
        m, "ttest_student", keys, F.col("t"), F.col("n1"), F.col("n2"), df1=dof,
        p_value=t_p(F.col("t"), dof), alpha=alpha,
    )


def ttest_welch(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    sample: str = "period",
    pair: tuple[str, str] = PERIODS,
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """Two-sample t test with unequal variances, two-sided."""
    m = _two_samples(samples, keys, sample, pair)
    s1, s2 = F.try_divide(F.col("var1"), F.col("n1")), F.try_divide(F.col("var2"), F.col("n2"))
    shares = F.try_divide(s1 * s1, F.col("n1") - 1) + F.try_divide(s2 * s2, F.col("n2") - 1)
    m = m.withColumns({
        "t": F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(s1 + s2)),
        "dof": F.try_divide((s1 + s2) * (s1 + s2), shares),
    })
    return results(
        m, "ttest_welch", keys, F.col("t"), F.col("n1"), F.col("n2"), df1=F.col("dof"),
        p_value=t_p(F.col("t"), F.col("dof")), alpha=alpha,
    )


def cohens_d(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    sample: str = "period",
    pair: tuple[str, str] = PERIODS,
) -> DataFrame:
    """Effect size (first mean minus second) over the pooled deviation.

    Sample sizes count the values present, as the means and deviations do.
    """
    m = _two_samples(samples, keys, sample, pair)
    d = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(_pooled_variance()))
    return results(m, "cohens_d", keys, d, F.col("n1"), F.col("n2"))


def _anova(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F ratio per key from each group's size, mean and squares about its mean.

    The squares between groups are summed from the distances of the group means, not
    taken as a difference of two large sums.
    """
    of_key = Window.partitionBy(*keys)
    n, mean = F.col("n").cast("double"), F.col("mean")
    # means are centred on one of them first, so that a common offset costs no digits
    centred = groups.withColumn("_shift", mean - F.min(mean).over(of_key))
    about = centred.withColumn("_gap", F.col("_shift") - F.sum(n * F.col("_shift")).over(of_key) / F.sum(n).over(of_key))
    per_key = about.groupBy(*keys).agg(
        F.count("n").alias("groups"),
        F.sum("n").alias("n"),
        F.sum(n * F.col("_gap") * F.col("_gap")).alias("between"),
        F.sum("squares").alias("within"),
    )
    dof1, dof2 = F.col("groups") - 1, F.col("n") - F.col("groups")
    return per_key.withColumns({
        "dof1": dof1.cast("double"),
        "dof2": dof2.cast("double"),
        "f": F.try_divide(F.try_divide(F.col("between"), dof1), F.try_divide(F.col("within"), dof2)),
    })


def anova_of_groups(groups: DataFrame, test: str, keys: Sequence[str], alpha: float) -> DataFrame:
    """Analysis of variance of finished groups; a key's groups are few rows."""
    a = _anova(groups, keys)
    p = f_p(F.col("f"), F.col("dof1"), F.col("dof2"))
    return results(
        a, test, keys, F.col("f"), F.col("n"), F.col("groups"),
        F.col("dof1"), F.col("dof2"), p, alpha,
    )


def anova_oneway(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    group: str = "subreddit",
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """One-way analysis of variance; ``n1`` is the row count and ``n2`` the group count."""
    rows = observed(samples).filter(F.col(group).isNotNull())
    groups = rows.groupBy(*keys, group).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("squares"),
    )
    return anova_of_groups(groups, "anova_oneway", keys, alpha)


def _with_skewness_z(m: DataFrame) -> DataFrame:
    """Add ``zs``, the transformed skewness (D'Agostino)."""
    n, w2 = F.col("size"), F.col("w2")
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    m = m.withColumns({
        "y": F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2))),
        "w2": F.sqrt(2 * (beta - 1)) - 1,
    })
    return m.withColumn("zs", F.asinh(F.col("y") / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2)))


def _with_kurtosis_z(m: DataFrame) -> DataFrame:
    """Add ``zk``, the transformed kurtosis (Anscombe and Glynn)."""
    n, s, a, d = F.col("size"), F.col("s"), F.col("a"), F.col("d")
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    spread = F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    m = m.withColumns({
        "x": (F.col("kurt") - 3 * (n - 1) / (n + 1)) / F.sqrt(variance),
        "s": 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * spread,
    })
    m = m.withColumn("a", 6 + 8 / s * (2 / s + F.sqrt(1 + 4 / (s * s))))
    m = m.withColumn("d", 1 + F.col("x") * F.sqrt(2 / (a - 4)))
    root = F.signum(d) * F.cbrt(F.try_divide(1 - 2 / a, F.abs(d)))
    return m.withColumn("zk", (1 - 2 / (9 * a) - root) / F.sqrt(2 / (9 * a)))


def dagostino_k2(
    samples: DataFrame, keys: Sequence[str] = ("variable",), alpha: float = DEFAULT_ALPHA
) -> DataFrame:
    """D'Agostino-Pearson normality test; null below eight values or without any spread."""
    m = observed(samples).groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.var_pop("value").alias("variance"),
        F.skewness("value").alias("skew"),
        (F.kurtosis("value") + 3).alias("kurt"),
    )
    # A sample too small or constant is tested at n = 8 and blanked afterwards, so
    # no formula meets a zero divisor.
    usable = (F.col("n") >= 8) & (F.col("variance") > 0)
    m = m.withColumn("size", F.when(usable, F.col("n")).otherwise(8).cast("double"))
    m = _with_kurtosis_z(_with_skewness_z(m))
    k2 = F.col("zs") * F.col("zs") + F.col("zk") * F.col("zk")
    m = m.withColumn("k2", F.when(usable, k2))
    return results(
        m, "dagostino_k2", keys, F.col("k2"), F.col("n"), df1=F.lit(2.0),
        p_value=F.exp(-F.col("k2") / 2), alpha=alpha,
    )
