"""The three sets of tests run on the finished monthly tables.

Each returns one results frame with ``(test, variable, slice, n1, n2, statistic,
df1, df2, p_value, keep_null)``. The tables they read are small (one row per month,
or per community and month) and are read several times, so pass stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sentiseries.functions.bins import with_bins
from sentiseries.operators.change import (
    before_after, change_table, long_samples, period_mean_diff, split_before_after,
)
from sentiseries.sources.storage import stored
from sentiseries.sources.submissions import union_by_name
from sentiseries.stats.chi2 import chi2_independence
from sentiseries.stats.levene import levene_placed
from sentiseries.stats.moments import (
    anova_oneway, cohens_d, dagostino_k2, ttest_student, ttest_welch,
)
from sentiseries.stats.order import placed_samples
from sentiseries.stats.ranks import kruskal_placed, mann_whitney_placed
from sentiseries.stats.results import results
from sentiseries.stats.shapiro import shapiro_placed

KEYS = ("variable", "slice")
BOTH = "before vs after"
ACROSS = "across communities"
OVERALL = ("overall_sentiment_score", "overall_top40_sentiment_score")
AVERAGES = ("pos_avg_score", "neg_avg_score", "total_avg_score")
COUNTS = ("num_pos_submissions", "num_neg_submissions", "overall_num_submissions")
COMMUNITY = ("avg_sentiment_score", "top40_avg_sentiment_score")


def _only(samples: DataFrame, *variables: str) -> DataFrame:
    return samples.filter(F.col("variable").isin(*variables))


def _sliced(samples: DataFrame, by: str) -> DataFrame:
    return samples.withColumn("slice", F.col(by))


def _whole(samples: DataFrame, name: str = "all") -> DataFrame:
    return samples.withColumn("slice", F.lit(name))


class RankTests:
    """The samples of several rank tests, placed together once.

    ``samples`` names the tests' samples with the column that tells them apart; each test's
    variables and slices are keys of their own in one table of counts.
    """

    def __init__(self, samples: dict[str, tuple[DataFrame, str | None]]):
        parts = [
            frame.select(F.lit(test).alias("test"), *KEYS, (F.lit("") if group is None else F.col(group).cast("string")).alias("sample"), F.col("value").cast("double").alias("value"))
            for test, (frame, group) in samples.items()
        ]
        self.placed = placed_samples(union_by_name(parts), ["test", *KEYS], "sample")

    def of(self, test: str) -> DataFrame:
        return self.placed.filter(F.col("test") == test).drop("test")


def period_samples(table: DataFrame, values: Sequence[str], cut: str) -> DataFrame:
    """Long samples of a table with a ``date``, marked before or after the cut."""
    dated = split_before_after(table, cut).filter("period IS NOT NULL")
    return long_samples(dated, ["period"], values)


def mean_difference(samples: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean after minus mean before, as results rows."""
    both = period_mean_diff(samples, keys)
    return results(both, "mean_difference", keys, F.col("mean_diff"), F.col("n1"), F.col("n2"))


def overall_battery(overall: DataFrame, cut: str, alpha: float = 0.05) -> DataFrame:
    """Overall and top-k monthly sentiment, before against after."""
    mean, top = OVERALL
    samples = period_samples(overall, OVERALL, cut)
    both = _whole(samples, BOTH)
    ranks = RankTests({"shapiro": (_sliced(samples, "period"), None), "both": (both, "period")})
    return union_by_name([
        shapiro_placed(ranks.of("shapiro"), KEYS, alpha),
        levene_placed(ranks.of("both"), KEYS, alpha),
        mann_whitney_placed(_only(ranks.of("both"), mean), KEYS, alpha=alpha),
        ttest_student(_only(both, top), KEYS, alpha=alpha),
        mean_difference(both),
        cohens_d(both, KEYS),
    ])


def significant_battery(significant: DataFrame, cut: str, alpha: float = 0.05) -> DataFrame:
    """Monthly scores and counts of strongly positive and negative posts.

    The variance test of the total compares the total before with the total after.
    """
    pos, neg, total = AVERAGES
    samples = period_samples(significant, AVERAGES + COUNTS, cut)
    averages = _only(samples, *AVERAGES)
    both = _whole(samples, BOTH)
    ranks = RankTests({"shapiro": (_sliced(averages, "period"), None), "levene": (_only(both, *AVERAGES), "period")})
    return union_by_name([
        shapiro_placed(ranks.of("shapiro"), KEYS, alpha),
        levene_placed(ranks.of("levene"), KEYS, alpha),
        ttest_student(_only(both, pos), KEYS, alpha=alpha),
        ttest_welch(_only(both, neg, total), KEYS, alpha=alpha),
        mean_difference(both),
        cohens_d(both, KEYS),
    ])


def paired_columns(change: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Samples that compare two columns: variable, ``period`` naming the column, value."""
    return union_by_name([
        long_samples(change, [], columns)
        .withColumnRenamed("variable", "period")
        .withColumn("variable", F.lit(name))
        for name, columns in pairs.items()
    ])


def change_columns(community: DataFrame, cut: str) -> DataFrame:
    """All before, after and change columns of both change tables, one row per community."""
    both = stored(before_after(community, cut), "before_after")
    median = change_table(both, "median")
    mean = change_table(both, "mean")
    kinds = ("absolute_change", "relative_change")
    for kind in kinds:
        median = median.withColumnRenamed(kind, f"median_{kind}")
        mean = mean.withColumnRenamed(kind, f"mean_{kind}")
    return median.join(mean, "subreddit")


def community_battery(
    community: DataFrame, cut: str, alpha: float = 0.05, bin_width: float = 0.05
) -> DataFrame:
    """Community-month sentiment: independence, normality, variance, location, change.

    Each kind of test runs once, over all its variables and slices together, and the rank
    tests share one placement of all their samples.
    """
    top = COMMUNITY[1]
    dated = split_before_after(community, cut).filter("period IS NOT NULL")
    samples = long_samples(dated, ["period", "subreddit"], COMMUNITY)
    across = _whole(samples, ACROSS)
    slices = union_by_name([
        _whole(samples), _sliced(samples, "period"), _sliced(samples, "subreddit")
    ])

    def categories(table: DataFrame, column: str, variable: str) -> DataFrame:
        return table.select(
            "subreddit", F.col(column).cast("string").alias("category"),
            F.lit(variable).alias("variable"), F.lit(ACROSS).alias("slice"),
        )

    binned = {v: with_bins(community, v, "bin", bin_width) for v in COMMUNITY}
    tables = union_by_name([
        categories(community, "sentiment_most", "sentiment_most"),
        categories(community, "top40_sentiment_most", "top40_sentiment_most"),
        *(categories(table, "bin", f"{v}_bin") for v, table in binned.items()),
    ])
    change = change_columns(community, cut)
    change_values = [c for c in change.columns if c != "subreddit"]
    relative = ("mean_relative_change", "median_relative_change")
    pairs = _whole(paired_columns(change, {
        "absolute_change": ("median_absolute_change", "mean_absolute_change"),
        "relative_change": relative,
        "mean": ("before_mean", "after_mean"),
        "median": ("before_median", "after_median"),
    }), ACROSS)
    relative_pair = _only(pairs, "relative_change")
    ranks = RankTests({
        "levene": (union_by_name([_whole(samples.drop("subreddit"), BOTH), pairs]), "period"),
        "kruskal": (_only(across, top), "subreddit"),
        "shapiro": (_whole(long_samples(change, [], change_values), ACROSS), None),
    })
    return union_by_name([
        chi2_independence(tables, "subreddit", "category", KEYS, alpha),
        dagostino_k2(slices, KEYS, alpha),
        levene_placed(ranks.of("levene"), KEYS, alpha),
        anova_oneway(across, KEYS, alpha=alpha),
        kruskal_placed(ranks.of("kruskal"), KEYS, alpha),
        shapiro_placed(ranks.of("shapiro"), KEYS, alpha),
        ttest_student(relative_pair, KEYS, pair=relative, alpha=alpha),
        mann_whitney_placed(_only(ranks.of("levene"), "relative_change"), KEYS, pair=relative, alpha=alpha),
    ])
