"""Density curves of samples, as violin charts draw them.

A Gaussian kernel estimate on an even grid for each key. Values are first shared between
the two grid points around them (linear binning), so that what is left of a key of any
size are as many weights as the grid has points; the weights are then convolved with the
kernel inside the key's row. The bandwidth is the deviation times n^(-1/5).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.stats.results import observed

POINTS = 128
CUT = 4.0


def _number(value: Column) -> Column:
    return value.cast("double")


def density(samples: DataFrame, keys: Sequence[str], value: str = "value", points: int = POINTS, cut: float = CUT) -> DataFrame:
    """(keys, point, x, density) over ``points`` even steps from ``cut`` bandwidths below the least value to as many above the largest.

    Nulls and NaN are left out. A key with one value, or with equal ones, has no curve.
    """
    if points < 2:
        raise ValueError("a grid has two points or more")
    rows = observed(samples, value).dropna(subset=list(keys)).select(*keys, _number(F.col(value)).alias("v"))
    ends = rows.groupBy(*keys).agg(
        F.count("v").cast("double").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.stddev_samp("v").alias("deviation")
    ).filter("deviation > 0")
    ends = ends.withColumn("width", F.col("deviation") * F.pow("n", F.lit(-0.2)))
    ends = ends.withColumn("start", F.col("least") - cut * F.col("width"))
    ends = ends.withColumn("step", (F.col("most") + cut * F.col("width") - F.col("start")) / (points - 1))
    ends = ends.select(*keys, "n", "width", "start", "step")
    # counted first, so that a value that occurs often is placed once
    counts = rows.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("ties"))
    placed = counts.join(ends, list(keys)).withColumn("place", (F.col("v") - F.col("start")) / F.col("step"))
    at = F.least(F.floor("place"), F.lit(points - 2)).cast("int")
    right = F.col("place") - at
    halves = F.explode(F.array(
        F.struct(at.alias("at"), (F.col("ties") * (1 - right)).alias("weight")), F.struct((at + 1).alias("at"), (F.col("ties") * right).alias("weight"))
    ))
    weights = placed.select(*keys, halves.alias("half")).groupBy(*keys, "half.at").agg(F.sum("half.weight").alias("weight"))
    # at most ``points`` weights a key
    grids = weights.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("weights")).join(ends, list(keys))

    def over(point: Column) -> Column:
        def kernel(total: Column, w: Column) -> Column:
            gap = (point - w["at"]) * F.col("step") / F.col("width")
            return total + w["weight"] * F.exp(-gap * gap / 2)

        return F.aggregate("weights", F.lit(0.0), kernel) / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))

    curve = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.struct(i.alias("point"), (F.col("start") + i * F.col("step")).alias("x"), over(i).alias("density")))
    return grids.select(*keys, F.explode(curve).alias("c")).select(*keys, "c.point", "c.x", "c.density")
