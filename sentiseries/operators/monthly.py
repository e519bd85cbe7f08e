"""Monthly series per community and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.functions.scalars import format_month, month_date
from sentiseries.operators.ranking import HEAP_MOST, by_score, first_k, most_frequent, top_k_per_group

MONTH_KEYS = ("year", "month", "subreddit")


def titled(scored: DataFrame) -> DataFrame:
    """Rows that have a title; only these enter the series."""
    return scored.filter(F.col("title").isNotNull())


def community_month_avg(scored: DataFrame) -> DataFrame:
    """Mean sentiment per community and month."""
    return titled(scored).groupBy(*MONTH_KEYS).agg(
        F.avg("sentiment_score").alias("avg_sentiment_score")
    )


def top_posts(
    scored: DataFrame,
    k: int = 40,
    tie_columns: Sequence[str] = ("id",),
    salts: int | None = None,
) -> DataFrame:
    """The k highest-scored posts of each community and month."""
    return top_k_per_group(titled(scored), MONTH_KEYS, by_score(tie_columns), k, salts=salts)


def top_posts_avg(scored: DataFrame, k: int = 40, tie_columns: Sequence[str] = ("id",)) -> DataFrame:
    """Mean sentiment of those posts."""
    return top_posts(scored, k, tie_columns).groupBy(*MONTH_KEYS).agg(
        F.avg("sentiment_score").alias("top40_avg_sentiment_score")
    )


def _mean_and_mode(posts: DataFrame, mean: str, mode: str) -> DataFrame:
    """Mean score and modal label per community-month from one pass over the posts.

    The first grouping leaves one row per label, the second folds those.
    """
    per_label = posts.groupBy(*MONTH_KEYS, "sentiment").agg(
        F.count("sentiment").alias("frequency"),
        F.sum("sentiment_score").alias("total"),
        F.count("sentiment_score").alias("n"),
    )
    return per_label.groupBy(*MONTH_KEYS).agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias(mean),
        most_frequent(F.col("sentiment"), F.col("frequency")).alias(mode),
    )


def with_month_date(df: DataFrame) -> DataFrame:
    return df.withColumns({"format_month": format_month(), "date": month_date()})


def community_month(
    scored: DataFrame,
    k: int = 40,
    tie_columns: Sequence[str] = ("id",),
    salts: int | None = None,
) -> DataFrame:
    """Mean and modal label of all posts and of the top k, per community and month.

    One scan: every group keeps its sums and a heap of its first k posts, filled in the
    map tasks and merged after the one shuffle. Beyond ``HEAP_MOST``, or with ``salts``, the
    top k are ranked in a scan of their own and joined, one row per community-month. Ties in
    the ranking go to the smallest tie column and ties between labels to the first in the
    alphabet.
    """
    posts = titled(scored)
    if k > HEAP_MOST or salts is not None:
        everyone = _mean_and_mode(posts, "avg_sentiment_score", "sentiment_most")
        top = _mean_and_mode(
            top_posts(scored, k, tie_columns, salts), "top40_avg_sentiment_score", "top40_sentiment_most"
        )
        return with_month_date(everyone.join(top, list(MONTH_KEYS), "left"))

    def mean(of: str) -> Column:
        return F.try_divide(F.sum(of), F.count(of))

    groups = posts.groupBy(*MONTH_KEYS).agg(
        mean("sentiment_score").alias("avg_sentiment_score"),
        F.mode("sentiment", True).alias("sentiment_most"),
        first_k(posts, tie_columns, ("sentiment", "sentiment_score"), k).alias("top"),
    )
    # the k rows of a group lie in one partition already: no second shuffle
    top = groups.withColumn("top", F.explode("top")).groupBy(*MONTH_KEYS).agg(
        F.first("avg_sentiment_score").alias("avg_sentiment_score"),
        F.first("sentiment_most").alias("sentiment_most"),
        mean("top.sentiment_score").alias("top40_avg_sentiment_score"),
        F.mode("top.sentiment", True).alias("top40_sentiment_most"),
    )
    return with_month_date(top)


def overall_month(community: DataFrame) -> DataFrame:
    """Monthly series over all communities, each community counting once.

    The score is the mean of the community means and the label the mode of the
    community modes. ``top40_sentiment`` is the mode of the top-k modes.
    """
    return community.groupBy("date", "year", "month", "format_month").agg(
        F.avg("avg_sentiment_score").alias("overall_sentiment_score"),
        F.avg("top40_avg_sentiment_score").alias("overall_top40_sentiment_score"),
        F.mode("sentiment_most", True).alias("overall_sentiment"),
        F.mode("top40_sentiment_most", True).alias("top40_sentiment"),
    )


def overall_by_posts(scored: DataFrame) -> DataFrame:
    """Mean sentiment of all posts of a month, each post counting once."""
    return with_month_date(titled(scored).groupBy("year", "month").agg(
        F.count("title").alias("posts"), F.avg("sentiment_score").alias("mean_sentiment_score")
    ))


def overall_modal_label(community: DataFrame) -> DataFrame:
    """Most common community label per month, joined back onto the month's row count."""
    votes = community.groupBy("date", "year", "month", "format_month", "sentiment_most").agg(
        F.count("sentiment_most").alias("sentiment_sum")
    )
    return votes.groupBy("date", "year", "month", "format_month").agg(
        most_frequent(F.col("sentiment_most"), F.col("sentiment_sum")).alias("overall_sentiment"),
        F.max("sentiment_sum").alias("sentiment_sum"),
    )
