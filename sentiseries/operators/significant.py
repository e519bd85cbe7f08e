"""Counts, sums and means of strongly positive and negative posts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Output names of (count, sum, mean) over all posts, by grouping.
OVERALL_TOTALS = ("overall_num_submissions", "overall_sum_score", "total_avg_score")
GROUP_TOTALS = ("num_total_submissions", "total_sum_score", "total_avg_score")


def _measures(side: Column) -> tuple[Column, Column, Column]:
    """Count, sum and mean where ``side`` holds; all null when it never does."""
    seen = F.count_if(side) > 0
    return (
        F.when(seen, F.count(F.when(side, F.col("title")))),
        F.sum(F.when(side, F.col("score"))),
        F.avg(F.when(side, F.col("score"))),
    )


def significant(
    scored: DataFrame,
    keys: Sequence[str] = ("date",),
    totals: tuple[str, str, str] = OVERALL_TOTALS,
    cut: float = 0.5,
) -> DataFrame:
    """All nine measures per key in one aggregation over one scan.

    A post is significant when its score is strictly beyond ``cut``. A key without
    any post on a side has null there, not zero, as an outer join of separate
    aggregates would give.
    """
    pos = _measures(F.col("sentiment_score") > cut)
    neg = _measures(F.col("sentiment_score") < -cut)
    num, total, mean = totals
    return scored.groupBy(*keys).agg(
        pos[0].alias("num_pos_submissions"),
        neg[0].alias("num_neg_submissions"),
        pos[1].alias("pos_sum_score"),
        neg[1].alias("neg_sum_score"),
        pos[2].alias("pos_avg_score"),
        neg[2].alias("neg_avg_score"),
        F.count("title").alias(num),
        F.sum("score").alias(total),
        F.avg("score").alias(mean),
    )


def significant_counts(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """What both tables are made of, per date and community, from one scan.

    Per side (``pos``, ``neg``, ``all``): rows, titles, scores that are not null, their sum.
    """
    sides = {"pos": F.col("sentiment_score") > cut, "neg": F.col("sentiment_score") < -cut, "all": F.lit(True)}
    return scored.groupBy("date", "subreddit").agg(*(
        measure.alias(f"{side}_{name}")
        for side, where in sides.items()
        for name, measure in (
            ("rows", F.count_if(where)), ("titles", F.count(F.when(where, F.col("title")))),
            ("scores", F.count(F.when(where, F.col("score")))), ("sum", F.sum(F.when(where, F.col("score")))),
        )
    ))


def from_counts(
    counts: DataFrame, keys: Sequence[str] = ("date",), totals: tuple[str, str, str] = OVERALL_TOTALS
) -> DataFrame:
    """The table of ``significant`` from finished ``significant_counts``."""

    def of(side: str) -> tuple[Column, Column, Column]:
        total = F.sum(f"{side}_sum")
        return F.sum(f"{side}_titles"), total, F.try_divide(total, F.sum(f"{side}_scores"))

    pos, neg, (number, total, mean) = of("pos"), of("neg"), of("all")
    return counts.groupBy(*keys).agg(
        F.when(F.sum("pos_rows") > 0, pos[0]).alias("num_pos_submissions"),
        F.when(F.sum("neg_rows") > 0, neg[0]).alias("num_neg_submissions"),
        pos[1].alias("pos_sum_score"), neg[1].alias("neg_sum_score"),
        pos[2].alias("pos_avg_score"), neg[2].alias("neg_avg_score"),
        number.alias(totals[0]), total.alias(totals[1]), mean.alias(totals[2]),
    )


def significant_overall(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    return significant(scored, ("date",), OVERALL_TOTALS, cut)


def significant_by_group(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    return significant(scored, ("date", "subreddit"), GROUP_TOTALS, cut)


def outer_join_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full-outer join of aggregates that share their keys."""
    return reduce(lambda left, right: left.join(right, list(keys), "outer"), frames)


def significant_by_joins(
    scored: DataFrame,
    keys: Sequence[str] = ("date",),
    totals: tuple[str, str, str] = OVERALL_TOTALS,
    cut: float = 0.5,
) -> DataFrame:
    """The same table as an outer-join chain, kept as a cross-check of ``significant``."""

    def side(rows: DataFrame, names: tuple[str, str, str]) -> DataFrame:
        count, total, mean = names
        return rows.groupBy(*keys).agg(
            F.count("title").alias(count), F.sum("score").alias(total), F.avg("score").alias(mean)
        )

    above, below = F.col("sentiment_score") > cut, F.col("sentiment_score") < -cut
    frames = [
        side(scored.filter(above), ("num_pos_submissions", "pos_sum_score", "pos_avg_score")),
        side(scored.filter(below), ("num_neg_submissions", "neg_sum_score", "neg_avg_score")),
        side(scored, totals),
    ]
    return outer_join_chain(frames, keys)
