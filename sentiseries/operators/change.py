"""Before/after tables around a cut date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.functions.scalars import absolute_change, period, period_of_month, relative_change


def split_before_after(df: DataFrame, cut: str, date: str = "date") -> DataFrame:
    """Add ``period`` instead of making two frames."""
    return df.withColumn("period", period(F.col(date), cut))


def split_before_after_ym(df: DataFrame, cut: str) -> DataFrame:
    return df.withColumn("period", period_of_month(F.col("year"), F.col("month"), cut))


def _in(side: str, value: str) -> Column:
    return F.when(F.col("period") == side, F.col(value))


def group_median_mean(community: DataFrame) -> DataFrame:
    """Median of the monthly means and mean of the monthly top-k means per community.

    The exact median buffers a community's values; on a monthly series that is one
    value per month.
    """
    return community.groupBy("subreddit").agg(
        F.median("avg_sentiment_score").alias("median_sentiment"),
        F.avg("top40_avg_sentiment_score").alias("mean_top40_sentiment"),
    )


def before_after(community: DataFrame, cut: str) -> DataFrame:
    """Both statistics for both periods per community, in one grouping.

    A community seen in one period only keeps its row with nulls on the other side.
    """
    return split_before_after(community, cut).filter("period IS NOT NULL").groupBy("subreddit").agg(
        F.median(_in("before", "avg_sentiment_score")).alias("before_median"),
        F.avg(_in("before", "top40_avg_sentiment_score")).alias("before_mean"),
        F.median(_in("after", "avg_sentiment_score")).alias("after_median"),
        F.avg(_in("after", "top40_avg_sentiment_score")).alias("after_mean"),
    )


def before_after_outer(community: DataFrame, cut: str) -> DataFrame:
    """The same table by an outer join of the two periods, as a cross-check."""
    split = split_before_after(community, cut)

    def one(side: str) -> DataFrame:
        return split.filter(F.col("period") == side).groupBy("subreddit").agg(
            F.median("avg_sentiment_score").alias(f"{side}_median"),
            F.avg("top40_avg_sentiment_score").alias(f"{side}_mean"),
        )

    return one("before").join(one("after"), "subreddit", "outer")


def change_table(before_after_table: DataFrame, statistic: str) -> DataFrame:
    """Before, after, absolute and relative change of ``median`` or ``mean``."""
    before, after = F.col(f"before_{statistic}"), F.col(f"after_{statistic}")
    return before_after_table.select(
        "subreddit",
        before,
        after,
        absolute_change(before, after).alias("absolute_change"),
        relative_change(before, after).alias("relative_change"),
    )


def melt_change(change: DataFrame, statistic: str) -> DataFrame:
    """Long form ``(subreddit, time, average)`` of a change table."""
    values = [f"before_{statistic}", f"after_{statistic}", "absolute_change"]
    return change.unpivot("subreddit", values, "time", "average")


def long_samples(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Values as ``(keys..., variable, value)`` rows, the shape every test takes."""
    typed = df.select(*keys, *(F.col(v).cast("double").alias(v) for v in values))
    return typed.unpivot(list(keys), list(values), "variable", "value")


def period_mean_std(samples: DataFrame, keys: Sequence[str] = ("variable",)) -> DataFrame:
    """Mean and sample standard deviation per key and period."""
    return samples.groupBy(*keys, "period").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )


def period_mean_diff(samples: DataFrame, keys: Sequence[str] = ("variable",)) -> DataFrame:
    """Mean after minus mean before."""
    means = samples.groupBy(*keys).agg(
        F.count(_in("before", "value")).alias("n1"),
        F.count(_in("after", "value")).alias("n2"),
        F.avg(_in("before", "value")).alias("before_mean"),
        F.avg(_in("after", "value")).alias("after_mean"),
    )
    return means.withColumn("mean_diff", F.col("after_mean") - F.col("before_mean"))
