"""Tables behind the charts: distributions, ranked bars and monthly lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.functions.bins import with_bins
from sentiseries.functions.scalars import period
from sentiseries.operators.change import long_samples

SERIES_VALUES = ("avg_sentiment_score", "top40_avg_sentiment_score")


def distribution_by_group(
    community: DataFrame, values: Sequence[str] = SERIES_VALUES
) -> DataFrame:
    """Five-number summary of each monthly series per community.

    The exact percentiles buffer one value per month of a community.
    """

    def at(share: float) -> Column:
        return F.percentile("value", F.lit(share))

    samples = long_samples(community, ["subreddit"], values).filter("value IS NOT NULL")
    return samples.groupBy("subreddit", "variable").agg(
        F.count("value").alias("n"),
        F.min("value").alias("low"),
        at(0.25).alias("lower_quartile"),
        at(0.5).alias("median"),
        at(0.75).alias("upper_quartile"),
        F.max("value").alias("high"),
    )


def histogram_by_group(
    community: DataFrame, value: str = "avg_sentiment_score", width: float = 0.05
) -> DataFrame:
    """Months per community and score bin; the overall minimum lies in the first bin."""
    binned = with_bins(community, value, "bin", width, include_lowest=True)
    return binned.filter("bin IS NOT NULL").groupBy("subreddit", "bin").agg(
        F.count(F.lit(1)).alias("months")
    )


def ranked_groups(group_statistics: DataFrame, by: str) -> DataFrame:
    """Communities with the statistic ``by``, highest first, names breaking ties."""
    return group_statistics.select("subreddit", by).orderBy(
        F.col(by).desc_nulls_last(), F.col("subreddit")
    )


def monthly_lines(series: DataFrame, values: Sequence[str], cut: str) -> DataFrame:
    """Long form ``(date, period, variable, value)`` of a monthly table, in date order."""
    marked = series.withColumn("period", period(F.col("date"), cut))
    return long_samples(marked, ["date", "period"], values).orderBy("date", "variable")
