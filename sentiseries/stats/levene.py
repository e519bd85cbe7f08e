"""Test of equal variances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.stats.moments import anova_of_groups
from sentiseries.stats.order import median, middles, placed_samples
from sentiseries.stats.results import DEFAULT_ALPHA


def levene(
    samples: DataFrame,
    keys: Sequence[str] = ("variable",),
    group: str = "period",
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """Median-centred Levene test: an analysis of variance of the distances to the
    group medians. ``n1`` is the row count and ``n2`` the group count.

    Everything comes from the placed value counts; the samples are read once.
    """
    return levene_placed(placed_samples(samples, keys, group), keys, alpha)


def levene_placed(placed: DataFrame, keys: Sequence[str], alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """``levene`` of samples already placed.

    Medians are one row per group and slice, so that a large group's counts meet them in as
    many tasks as the session has shuffle partitions. Distances are summed from near their
    mean, so that their squares lose no digits.
    """
    by = [*keys, "sample"]
    placed = placed.select(*by, "value", "ties", F.col("before_in_sample").alias("before"), F.col("n_in_sample").alias("n"))
    slices = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, high = middles()
    above, below = F.col("before") >= high, F.col("before") + F.col("ties") < low

    def mean(side: Column) -> Column:
        return F.try_divide(F.sum(F.when(side, F.col("ties") * F.col("value"))), F.sum(F.when(side, F.col("ties"))))

    centres = placed.groupBy(*by).agg(
        median().alias("median"), mean(above).alias("upper"), mean(below).alias("lower")
    )
    # about half the way between the means of either side: near the mean distance
    near = F.coalesce((F.col("upper") - F.col("lower")) / 2, F.lit(0.0))
    each = F.explode(F.sequence(*(F.lit(i).cast("long") for i in (0, slices - 1)))).alias("_part")
    centres = centres.select(*by, "median", near.alias("near"), each)
    parted = placed.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(slices)))
    gap = F.abs(F.col("value") - F.col("median")) - F.col("near")
    n = F.sum("ties")
    total, squares = F.sum(F.col("ties") * gap), F.sum(F.col("ties") * gap * gap)
    groups = parted.join(centres, [*by, "_part"]).groupBy(*by).agg(
        n.alias("n"), (F.max("near") + total / n).alias("mean"), F.greatest(squares - total * total / n, F.lit(0.0)).alias("squares")
    )
    return anova_of_groups(groups, "levene", keys, alpha)
