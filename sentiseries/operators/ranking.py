"""Top-k per group and most-common value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.internal import InternalFunction

# Spark cuts each map task's rows of a group to k before the shuffle only up to this k.
PRE_SHUFFLE_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
# The longest heap that an aggregate keeps for a group.
HEAP_MOST = 1000


def by_score(tie_columns: Sequence[str] = ("id",), score: str = "score") -> list[Column]:
    """Highest score first, nulls last, ties by the smallest tie columns."""
    return [F.col(score).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in tie_columns)]


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window))


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int = 40,
    rank: str = "upvote_rank",
    salts: int | None = None,
    salt_on: Sequence[str] = (),
) -> DataFrame:
    """The first ``k`` rows of each group, with their rank.

    ``row_number() <= k`` plans as a group limit inside every map task, so a hot
    group sends at most k rows per map task to the task that ranks it. For a k beyond
    the session's ``PRE_SHUFFLE_LIMIT`` Spark makes no such cut; then the group is
    split over ``salts`` first (as many as the session has shuffle partitions), each
    part cut to its own first k, and only the survivors are ranked together. The
    result is the same either way.
    """
    if salts is None:
        conf = df.sparkSession.conf
        cut_early = k <= int(conf.get(PRE_SHUFFLE_LIMIT, "1000"))
        salts = 1 if cut_early else int(conf.get("spark.sql.shuffle.partitions"))
    if salts > 1:
        spread = F.pmod(F.xxhash64(*(salt_on or df.columns)), F.lit(salts))
        parts = _ranked(df.withColumn("_salt", spread), [*keys, "_salt"], order, "_part_rank")
        df = parts.filter(F.col("_part_rank") <= k).drop("_salt", "_part_rank")
    return _ranked(df, keys, order, rank).filter(F.col(rank) <= k)


def first_k(
    df: DataFrame, tie_columns: Sequence[str] = ("id",), keep: Sequence[str] = (), k: int = 40, score: str = "score"
) -> Column:
    """Aggregate: the first ``k`` rows in the order of ``by_score``, as structs that hold ``keep``.

    A bounded heap in the aggregation buffer, so map tasks send at most k structs per
    group and other aggregates can share the pass. Ties that the tie columns leave open go
    by the kept columns.
    """
    number = F.col(score)
    if isinstance(df.schema[score].dataType, T.FractionalType):
        # NaN counts as the highest score, as in a sort
        falling = [F.when(F.isnan(number.cast("double")), 0).otherwise(1), -number]
    else:
        falling = [F.bitwise_not(number)]
    rising = [x for c in tie_columns for x in (F.col(c).isNull(), F.col(c))]
    place = [x.alias(f"_{i}") for i, x in enumerate([number.isNull(), *falling, *rising])]
    return InternalFunction.collect_top_k(F.struct(*place, *(F.col(c) for c in keep)), k, True)


def label_frequency(
    df: DataFrame, keys: Sequence[str], label: str = "sentiment", out: str = "frequency"
) -> DataFrame:
    """Rows per group and label; the null label counts zero, as ``count(label)`` does."""
    return df.groupBy(*keys, label).agg(F.count(label).alias(out))


def most_frequent(label: Column, frequency: Column) -> Column:
    """Aggregate: the label with the highest frequency, ties to the first in the alphabet."""
    return F.min_by(label, F.struct(-frequency, label))


def modal_label(
    df: DataFrame, keys: Sequence[str], label: str = "sentiment", out: str = "sentiment_most"
) -> DataFrame:
    """Most common label per group.

    Counting per (group, label) first means the shuffle carries a few rows per
    group and map task however large the group is.
    """
    counts = label_frequency(df, keys, label, "_frequency")
    best = most_frequent(F.col(label), F.col("_frequency"))
    return counts.groupBy(*keys).agg(best.alias(out))
