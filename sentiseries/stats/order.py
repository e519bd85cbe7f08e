"""Positions of values in sorted order, without sorting a whole group in one task.

A window over a test's key would send all of its values to one task. Here equal values
are counted first (so one frequent value is one row), the counts are range-partitioned
by key and value and stored with the number of their partition, the partitions' totals
are accumulated, and only rows of one key in one partition are sorted together. The
number of partitions is the session's; a key may lie in many of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentiseries.sources.storage import stored
from sentiseries.stats.results import observed


def value_counts(
    samples: DataFrame, keys: Sequence[str], extra: dict[str, Column] | None = None
) -> DataFrame:
    """``ties``: how often each value occurs per key, plus any further aggregates.

    Rows without a key belong to no test. A negative zero counts as zero; grouping
    already treats the two alike.
    """
    more = [column.alias(name) for name, column in (extra or {}).items()]
    keyed = observed(samples).dropna(subset=list(keys))
    typed = keyed.withColumn("value", F.col("value").cast("double"))
    return typed.groupBy(*keys, "value").agg(F.count("value").alias("ties"), *more)


def with_positions(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``before`` (values of the key that are smaller) and ``n`` (all of them).

    The counts are placed and written once, when this is called: what they were
    counted from is read once, and the boundaries between partitions stay the same
    whatever is computed again.
    """
    ranged = counts.repartitionByRange(*keys, "value").withColumn("_slice", F.spark_partition_id())
    placed = stored(ranged, "value_counts")
    totals = placed.groupBy(*keys, "_slice").agg(F.sum("ties").alias("_total"))
    of_key = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "_slice",
        (F.sum("_total").over(of_key.orderBy("_slice")) - F.col("_total")).alias("_offset"),
        F.sum("_total").over(of_key).alias("n"),
    )
    within = Window.partitionBy(*keys, "_slice").orderBy("value")
    ordered = placed.withColumn("before", F.sum("ties").over(within) - F.col("ties"))
    joined = ordered.join(offsets, [*keys, "_slice"])
    return joined.withColumn("before", F.col("before") + F.col("_offset")).drop("_slice", "_offset")


def placed_samples(samples: DataFrame, keys: Sequence[str], group: str | None = None) -> DataFrame:
    """Every value of every group with its position in the group and in the whole key, placed once.

    Columns: the keys, ``sample`` (the group, or empty), ``value``, ``ties`` (in the group),
    ``before_in_sample`` and ``n_in_sample``; ``same`` (the value's ties in all groups),
    ``before`` and ``n``. One table of counts serves all rank tests, whatever number of
    variables and slices it holds; rows without a group or a key are left out.
    """
    samples = samples.withColumn("sample", F.lit("") if group is None else F.col(group).cast("string"))
    counts = value_counts(samples, [*keys, "sample"])
    ranged = counts.repartitionByRange(*keys, "value").withColumn("_slice", F.spark_partition_id())
    placed = stored(ranged, "placed_samples")
    totals = placed.groupBy(*keys, "sample", "_slice").agg(F.sum("ties").alias("_total"))
    of_sample = Window.partitionBy(*keys, "sample")
    of_key = Window.partitionBy(*keys)
    # over equal slices a running sum holds the whole slice, so what is before it is less by that
    offsets = totals.select(
        *keys, "sample", "_slice",
        (F.sum("_total").over(of_sample.orderBy("_slice")) - F.col("_total")).alias("_before_in_sample"),
        F.sum("_total").over(of_sample).alias("n_in_sample"),
        (F.sum("_total").over(of_key.orderBy("_slice")) - F.sum("_total").over(Window.partitionBy(*keys, "_slice"))).alias("_before"),
        F.sum("_total").over(of_key).alias("n"),
    )
    within = Window.partitionBy(*keys, "_slice")
    ordered = placed.withColumns({
        "same": F.sum("ties").over(Window.partitionBy(*keys, "_slice", "value")),
        "before": F.sum("ties").over(within.orderBy("value")),
        "before_in_sample": F.sum("ties").over(Window.partitionBy(*keys, "_slice", "sample").orderBy("value")) - F.col("ties"),
    })
    joined = ordered.join(offsets, [*keys, "sample", "_slice"])
    return joined.withColumns({
        "before": F.col("before") - F.col("same") + F.col("_before"),
        "before_in_sample": F.col("before_in_sample") + F.col("_before_in_sample"),
    }).drop("_slice", "_before", "_before_in_sample")


def average_rank() -> Column:
    """Mean rank of a value in its key, from the columns of ``placed_samples``."""
    return F.col("before") + (F.col("same") + 1) / 2


def middles() -> tuple[Column, Column]:
    """Positions of the two middle values of ``n``, the same one if n is odd."""
    return F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1


def median() -> Column:
    """Aggregate over placed values: the middle value, or the mean of the two of them."""

    def at(position: Column) -> Column:
        here = (F.col("before") < position) & (position <= F.col("before") + F.col("ties"))
        return F.max(F.when(here, F.col("value")))

    low, high = middles()
    return (at(low) + at(high)) / 2


def exact_median(samples: DataFrame, keys: Sequence[str], out: str = "median") -> DataFrame:
    """Median per key."""
    return with_positions(value_counts(samples, keys), keys).groupBy(*keys).agg(median().alias(out))
