"""Mergeable quantile sketches: a stored column per group and month that adds up.

The exact percentiles of the series buffer every value of a group. Over posts, a sketch
(KLL) holds what quantiles need in a few kilobytes, is filled in map tasks and merges: over
months, communities, or a month that is made again. ``rank_error`` bounds how far the
rank of a returned value is from the asked one, as a share of all values, in 99 of 100
cases. The exact path stays where it was, in ``series.distribution_by_group``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

K = 400
FIVE = {"low": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "high": 1.0}


def rank_error(k: int = K) -> float:
    """The published bound for one quantile of a sketch with parameter ``k``."""
    # fixed values of the published fit
    return 2.296 / k**0.9723


def sketches(df: DataFrame, keys: Sequence[str], value: str = "value", k: int = K) -> DataFrame:
    """(keys, n, sketch) of the values that are numbers; a group without any has no row."""
    number = F.col(value).cast("double")
    rows = df.filter(number.isNotNull() & ~F.isnan(number))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def merged(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    return table.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def with_quantiles(table: DataFrame, shares: dict[str, float]) -> DataFrame:
    """A column for each of ``shares``: the value with that share of values up to it."""
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))) for name, share in shares.items()}
    return table.withColumns(found)


def five_numbers(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Five-number summary of each group, as ``series.distribution_by_group`` has exactly."""
    return with_quantiles(merged(table, keys), FIVE).select(*keys, "n", *FIVE)
