"""Rank tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sentiseries.functions.pvalues import chi2_p, exact_rank_sum_p, two_sided_normal_p
from sentiseries.stats.moments import PERIODS
from sentiseries.stats.order import average_rank, placed_samples
from sentiseries.stats.results import DEFAULT_ALPHA, results

# Fixed value: the published rule "auto" is exact up to this size of the smaller sample.
EXACT_UP_TO = 8
METHODS = ("auto", "exact", "asymptotic")


def mann_whitney(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    sample: str = "period",
    pair: tuple[str, str] = PERIODS,
    alpha: float = DEFAULT_ALPHA,
    method: str = "auto",
) -> DataFrame:
    """Mann-Whitney U of the first sample, two-sided.

    ``asymptotic`` is the tie-corrected normal approximation with continuity
    correction. ``exact`` counts arrangements, which holds without ties. ``auto`` is exact
    when no values tie and the smaller sample has at most ``EXACT_UP_TO`` values.
    """
    wanted = samples.filter(F.col(sample).isin(*pair))
    return mann_whitney_placed(placed_samples(wanted, keys, sample), keys, pair, alpha, method)


def mann_whitney_placed(
    placed: DataFrame, keys: Sequence[str], pair: tuple[str, str] = PERIODS, alpha: float = DEFAULT_ALPHA, method: str = "auto"
) -> DataFrame:
    """``mann_whitney`` of samples already placed; keys with other samples than the pair are not for it."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    first, second = (F.when(F.col("sample") == name, F.col("ties")).otherwise(0) for name in pair)
    t = F.col("same").cast("double")
    sums = placed.withColumns({"in1": first, "in2": second, "rank": average_rank()}).groupBy(*keys).agg(
        F.sum("in1").alias("n1"),
        F.sum("in2").alias("n2"),
        F.sum(F.col("in1") * F.col("rank")).alias("rank_sum"),
        # summed over a value's samples this is ties^3 - ties
        F.sum(F.col("ties") * (t * t - 1)).alias("tie_sum"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("tie_sum"), n * (n - 1)))
    z = F.try_divide(F.abs(u - n1 * n2 / 2) - 0.5, F.sqrt(variance))
    has_both = (F.col("n1") > 0) & (F.col("n2") > 0)
    auto = (F.least("n1", "n2") <= EXACT_UP_TO) & (F.col("tie_sum") == 0)
    exact = auto if method == "auto" else F.lit(method == "exact")
    sums = sums.withColumns({
        "u": F.when(has_both, u),
        "z": F.when(has_both & ~exact, z),
        "exact_u": F.when(has_both & exact, u),
    })
    # abs(u - mean) below the correction gives a negative z: p is then capped at 1.
    approximate = F.when(F.col("z") > 0, two_sided_normal_p(F.col("z"))).when(F.col("z") <= 0, 1.0)
    p = F.coalesce(exact_rank_sum_p(F.col("exact_u"), F.col("n1"), F.col("n2")), approximate)
    return results(
        sums, "mann_whitney", keys, F.col("u"), F.col("n1"), F.col("n2"), p_value=p, alpha=alpha
    )


def kruskal_wallis(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    group: str = "subreddit",
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """Kruskal-Wallis H with tie correction; ``n1`` rows in ``n2`` groups."""
    return kruskal_placed(placed_samples(samples, keys, group), keys, alpha)


def kruskal_placed(placed: DataFrame, keys: Sequence[str], alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """``kruskal_wallis`` of samples already placed."""
    t = F.col("same").cast("double")
    groups = placed.withColumn("rank", average_rank()).groupBy(*keys, "sample").agg(
        F.sum("ties").cast("double").alias("size"),
        F.sum(F.col("ties") * F.col("rank")).alias("rank_sum"),
        # Summed over a value's groups this is ties^3 - ties.
        F.sum(F.col("ties") * (t * t - 1)).alias("tie_sum"),
    )
    # squared distances of the groups' mean ranks from the middle rank, not a difference
    # of two large sums
    all_ranks = F.sum("size").over(Window.partitionBy(*keys))
    gap = F.col("rank_sum") / F.col("size") - (all_ranks + 1) / 2
    sums = groups.withColumn("_gap", gap).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("size").alias("n"),
        F.sum(F.col("size") * F.col("_gap") * F.col("_gap")).alias("squares"),
        F.sum("tie_sum").alias("tie_sum"),
    )
    n = F.col("n")
    h = 12 / (n * (n + 1)) * F.col("squares")
    correction = 1 - F.try_divide(F.col("tie_sum"), n * n * n - n)
    dof = (F.col("groups") - 1).cast("double")
    sums = sums.withColumns({"dof": dof, "h": F.when(dof > 0, F.try_divide(h, correction))})
    return results(
        sums, "kruskal_wallis", keys, F.col("h"), n, F.col("groups"), df1=F.col("dof"),
        p_value=chi2_p(F.col("h"), F.col("dof")), alpha=alpha,
    )
