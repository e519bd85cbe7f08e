"""Fixed-width binning from the column's minimum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fixed_width_bin(value: Column, low: Column, high: Column, width: float) -> Column:
    """Index of the right-closed bin holding ``value``, edges counted from ``low``.

    Edge i is ``low + i * step`` with ``step = (low + width) - low``, for as many
    edges as fit below ``high + width``. The minimum itself and anything above the
    last edge has no bin (null). Dividing alone puts values that lie on an edge in
    the wrong bin now and then, so the quotient is corrected against the two
    neighbouring edges.
    """
    step = (low + F.lit(width)) - low
    last_edge = F.ceil((high + F.lit(width) - low) / F.lit(width)) - 1

    def edge(i: Column) -> Column:
        return low + i * step

    guess = F.ceil((value - low) / step) - 1
    index = (
        F.when(edge(guess) >= value, guess - 1)
        .when(edge(guess + 1) < value, guess + 1)
        .otherwise(guess)
    )
    return F.when((value > low) & (value <= edge(last_edge)), index.cast("int"))


def with_bins(
    df: DataFrame, value: str, out: str = "bin", width: float = 0.05, include_lowest: bool = False
) -> DataFrame:
    """Add the bin index of ``value``; ``include_lowest`` puts the minimum in bin 0.

    NaN is in no bin and does not move the others.
    """
    v = F.col(value).cast("double")
    number = F.when(~F.isnan(v), v)
    ends = df.agg(F.struct(F.min(number).alias("low"), F.max(number).alias("high"))).scalar()
    low, high = ends["low"].cast("double"), ends["high"].cast("double")
    index = fixed_width_bin(v, low, high, width)
    if include_lowest:
        index = F.when(v == low, F.lit(0)).otherwise(index)
    return df.withColumn(out, index)
