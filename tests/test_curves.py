"""Density curves, quantile sketches and the shared placement against plain versions."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sentiseries.operators import density, sketches
from sentiseries.stats import order
from sentiseries.stats.levene import levene, levene_placed
from sentiseries.stats.ranks import kruskal_placed, kruskal_wallis, mann_whitney, mann_whitney_placed


def samples(spark):
    pick = random.Random(3)
    rows = [("a", "v", round(pick.gauss(0, 1), 2), "before") for _ in range(400)] + [("b", "v", 5.0 + pick.randint(0, 3), "after") for _ in range(50)]
    rows += [("one", "v", 3.0, "before"), ("same", "v", 2.0, "before"), ("same", "v", 2.0, "after"), ("none", "v", None, "after"), (None, "v", 1.0, "before"), ("a", "v", float("nan"), "after")]
    return rows, spark.createDataFrame(rows, "grp string, variable string, value double, period string")


def test_density_is_the_kernel_sum(spark):
    rows, df = samples(spark)
    got = {}
    for r in density.density(df, ["grp"]).collect():
        got.setdefault(r["grp"], []).append((r["x"], r["density"]))
    assert set(got) == {"a", "b"} and all(len(c) == density.POINTS for c in got.values())
    for name, curve in got.items():
        values = [v for g, _, v, _ in rows if g == name and v is not None and v == v]
        width = statistics.stdev(values) * len(values) ** -0.2
        curve.sort()
        for x, d in curve[::9]:
            exact = sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in values) / (len(values) * width * math.sqrt(2 * math.pi))
            assert abs(d - exact) < 0.01 * max(d for _, d in curve)
        step = curve[1][0] - curve[0][0]
        assert abs(sum(d for _, d in curve) * step - 1) < 1e-3
        assert math.isclose(curve[0][0], min(values) - density.CUT * width) and math.isclose(curve[-1][0], max(values) + density.CUT * width)
    assert density.density(df.limit(0), ["grp"]).count() == 0
    with pytest.raises(ValueError):
        density.density(df, ["grp"], points=1)


def test_sketches_merge_over_parts(spark):
    df = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 3).alias("grp"), F.when(F.col("id") % 7 != 0, (F.col("id") * 7919 % 60_000).cast("double")).alias("value"))
    table = sketches.sketches(df, ["grp", "month"])
    assert table.count() == 12
    five = {r["grp"]: r for r in sketches.five_numbers(table, ["grp"]).collect()}
    for grp in range(3):
        values = sorted(i * 7919 % 60_000 for i in range(60_000) if i % 3 == grp and i % 7)
        assert five[grp]["n"] == len(values) and (five[grp]["low"], five[grp]["high"]) == (values[0], values[-1])
        for name in ("lower_quartile", "median", "upper_quartile"):
            rank = sum(v <= five[grp][name] for v in values) / len(values)
            assert abs(rank - sketches.FIVE[name]) <= 2 * sketches.rank_error()
    assert sketches.sketches(df.filter("value is null"), ["grp"]).count() == 0


def test_one_placement_serves_all_rank_tests(spark):
    _, df = samples(spark)
    pick = random.Random(9)
    rows = [("t", f"v{k}", float(pick.randint(0, 20 + k)), ("before", "after")[pick.randint(0, 1)]) for k in range(3) for _ in range(70)]
    many = spark.createDataFrame(rows, "grp string, variable string, value double, period string")
    placed = order.placed_samples(many, ["variable"], "period")
    for whole, parts in ((levene(many), levene_placed(placed, ["variable"])), (mann_whitney(many), mann_whitney_placed(placed, ["variable"])),
                         (kruskal_wallis(many, group="period"), kruskal_placed(placed, ["variable"]))):
        assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    for r in placed.collect():
        own = [v for _, name, v, p in rows if name == r["variable"]]
        mine = [v for _, name, v, p in rows if (name, p) == (r["variable"], r["sample"])]
        assert (r["before"], r["same"], r["n"]) == (sum(v < r["value"] for v in own), own.count(r["value"]), len(own))
        assert (r["before_in_sample"], r["ties"], r["n_in_sample"]) == (sum(v < r["value"] for v in mine), mine.count(r["value"]), len(mine))
    assert order.placed_samples(df.limit(0), ["variable"]).count() == 0
