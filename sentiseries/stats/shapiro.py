"""Shapiro-Wilk normality test after Royston (1995)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.functions.normal import polynomial, with_normal_quantile
from sentiseries.functions.pvalues import upper_normal_p
from sentiseries.stats.order import placed_samples
from sentiseries.stats.results import DEFAULT_ALPHA, results

# Polynomials of the published approximation, lowest power first.
# Corrections of the two extreme weights, in 1/sqrt(n).
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
# Mean, log deviation and bound of the transformed statistic for n up to 11, in n.
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
SMALL_BOUND = (-2.273, 0.459)
# Mean and log deviation for larger n, in log(n).
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)

# Positions from either end whose scores are added one by one; between them a run of
# ties takes one step, see ``_with_run_sums``.
EDGE = 64


def _runs(placed: DataFrame) -> DataFrame:
    """Placed values cut into runs ``lo`` to ``hi`` of 1-based positions.

    Within ``EDGE`` of an end a run is one position, elsewhere all of a value's ties.
    """
    first, last, n = F.col("before") + 1, F.col("before") + F.col("ties"), F.col("n")
    left = F.when(n <= 2 * EDGE, n).otherwise(F.lit(EDGE))
    right = F.when(n <= 2 * EDGE, n + 1).otherwise(n - EDGE + 1)

    def singles(low: Column, high: Column) -> Column:
        each = F.transform(F.sequence(low, high), lambda i: F.struct(i.alias("lo"), i.alias("hi")))
        return F.when(low <= high, each).otherwise(F.array().cast("array<struct<lo: bigint, hi: bigint>>"))

    low, high = F.greatest(first, left + 1), F.least(last, right - 1)
    between = F.when(low <= high, F.array(F.struct(low.alias("lo"), high.alias("hi")))).otherwise(F.array().cast("array<struct<lo: bigint, hi: bigint>>"))
    runs = F.concat(singles(first, F.least(last, left)), between, singles(F.greatest(first, right), last))
    return placed.withColumn("run", F.explode(runs)).select("*", "run.lo", "run.hi").drop("run")


def _density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def _with_run_sums(runs: DataFrame) -> DataFrame:
    """Add ``scores`` and ``score_squares``: the sums of a run's normal scores and their squares.

    The score of position i is the normal quantile of (i - 3/8) / (n + 1/4). A sum over a
    run is the integral from half a position before it to half a position after it, with
    the first two corrections of the midpoint rule; the integrals of the quantile and its
    square have closed forms. More than ``EDGE`` positions from an end what is left out is
    below 1e-12 of a position's score.
    """
    n, long = F.col("n"), F.col("hi") > F.col("lo")
    step = n + 0.25
    start = F.when(long, F.col("lo") - 0.5).otherwise(F.col("lo"))
    runs = with_normal_quantile(runs, (start - 0.375) / step, "z_lo")
    runs = with_normal_quantile(runs, F.when(long, (F.col("hi") + 0.5 - 0.375) / step), "z_hi")
    runs = runs.withColumns({"d_lo": _density(F.col("z_lo")), "d_hi": _density(F.col("z_hi"))})

    def between(of) -> Column:
        return of(F.col("z_hi"), F.col("d_hi")) - of(F.col("z_lo"), F.col("d_lo"))

    def corrected(integral: Column, slope, third) -> Column:
        return integral - between(slope) / (24 * step) + between(third) * 7 / (5760 * step * step * step)

    scores = corrected(
        -step * between(lambda z, d: d), lambda z, d: 1 / d, lambda z, d: (1 + 2 * z * z) / (d * d * d)
    )
    # the squares' integral is the share less z times the density; the shares differ by the length
    squares = corrected(
        F.col("hi") - F.col("lo") + 1 - step * between(lambda z, d: z * d), lambda z, d: 2 * z / d,
        lambda z, d: 4 * z * (2 + z * z) / (d * d * d),
    )
    z = F.col("z_lo")
    return runs.withColumns({"scores": F.when(long, scores).otherwise(z), "score_squares": F.when(long, squares).otherwise(z * z)})


def _with_statistic(sums: DataFrame) -> DataFrame:
    """Add ``w``, the squared weighted sum of the ordered values over their squares.

    All weights but the outermost are the normal scores over a common scale; the
    scores are antisymmetric, so each outer pair enters as a difference.
    """
    n, ssm = F.col("n"), F.col("score_squares")
    last, following = F.col("last_score"), F.col("next_score")
    outer, inner = F.col("outer"), F.col("inner")
    last_weight, next_weight = F.col("last_weight"), F.col("next_weight")
    usable = (n >= 3) & (F.col("squares") > 0)
    root = F.when(usable, 1 / F.sqrt(n))
    sums = sums.withColumns({
        "usable": usable,
        "root": root,
        "outer": F.col("x_last") - F.col("x_first"),
        "inner": F.col("x_next") - F.col("x_second"),
    }).withColumns({
        "last_weight": polynomial(F.col("root"), LAST_WEIGHT) + F.try_divide(last, F.sqrt(ssm)),
        "next_weight": polynomial(F.col("root"), NEXT_WEIGHT) + F.try_divide(following, F.sqrt(ssm)),
    }).withColumns({
        "one_scale": F.try_divide(ssm - 2 * last * last, 1 - 2 * last_weight * last_weight),
        "two_scale": F.try_divide(
            ssm - 2 * last * last - 2 * following * following,
            1 - 2 * last_weight * last_weight - 2 * next_weight * next_weight,
        ),
    })
    middle = F.col("score_sum") - last * outer
    weighted = (
        F.when(n == 3, outer * F.sqrt(F.lit(0.5)))
        .when(n <= 5, F.try_divide(middle, F.sqrt("one_scale")) + last_weight * outer)
        .otherwise(
            F.try_divide(middle - following * inner, F.sqrt("two_scale"))
            + last_weight * outer + next_weight * inner
        )
    )
    w = F.try_divide(F.col("weighted") * F.col("weighted"), F.col("squares"))
    return sums.withColumn("weighted", weighted).withColumn(
        "w", F.when(F.col("usable"), F.least(w, F.lit(1.0)))
    )


def _with_p_value(sums: DataFrame) -> DataFrame:
    """Add ``p``: exact for three values, else from the transformed statistic."""
    n, distance, bound = F.col("n"), F.col("distance"), F.col("bound")
    size, log_n = F.col("size"), F.col("log_n")
    sums = sums.withColumns({
        "size": n.cast("double"),
        "log_n": F.log(n.cast("double")),
        "distance": F.log(F.greatest(1 - F.col("w"), F.lit(1e-19))),
    }).withColumn("bound", polynomial(size, SMALL_BOUND))
    small = (-F.log(bound - distance) - polynomial(size, SMALL_MEAN)) / F.exp(polynomial(size, SMALL_LOG_SD))
    large = (distance - polynomial(log_n, LARGE_MEAN)) / F.exp(polynomial(log_n, LARGE_LOG_SD))
    sums = sums.withColumn("z", F.when(n <= 11, F.when(distance < bound, small)).otherwise(large))
    three = F.lit(6 / math.pi) * (F.asin(F.sqrt("w")) - F.asin(F.sqrt(F.lit(0.75))))
    p = (
        F.when(n == 3, F.greatest(three, F.lit(0.0)))
        .when((n <= 11) & (distance >= bound), F.lit(0.0))
        .otherwise(upper_normal_p(F.col("z")))
    )
    return sums.withColumn("p", F.when(F.col("usable"), p))


def shapiro_wilk(
    samples: DataFrame, keys: Sequence[str] = ("variable",), alpha: float = DEFAULT_ALPHA
) -> DataFrame:
    """W and its p-value per key; null below three values or without any spread.

    The published approximation was fitted for n up to 5000; beyond that the
    p-value extrapolates it.
    """
    return shapiro_placed(placed_samples(samples, keys), keys, alpha)


def shapiro_placed(placed: DataFrame, keys: Sequence[str], alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """``shapiro_wilk`` of samples already placed without a group, so that a value is one row."""
    values = placed.select(*keys, "value", "ties", "before", "n")
    middle = F.floor((F.col("n") + 1) / 2)
    near = values.groupBy(*keys).agg(
        F.max(F.when((F.col("before") < middle) & (middle <= F.col("before") + F.col("ties")), F.col("value"))).alias("near")
    )
    ordered = _with_run_sums(_runs(values))
    lo, hi, n, x = F.col("lo"), F.col("hi"), F.col("n"), F.col("value")
    length = hi - lo + 1

    def at(position: Column, of: Column = x) -> Column:
        return F.max(F.when((lo <= position) & (position <= hi), of))

    # squares about the mean, summed from near it so that they lose no digits
    gap = x - F.col("near")
    sums = ordered.join(near, list(keys)).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.sum(F.col("scores") * gap).alias("score_sum"),
        F.sum("score_squares").alias("score_squares"),
        at(n, F.col("z_lo")).alias("last_score"),
        at(n - 1, F.col("z_lo")).alias("next_score"),
        at(F.lit(1)).alias("x_first"),
        at(F.lit(2)).alias("x_second"),
        at(n - 1).alias("x_next"),
        at(n).alias("x_last"),
        F.sum(length * gap).alias("gaps"), F.sum(length * gap * gap).alias("gap_squares"),
    )
    squares = F.greatest(F.col("gap_squares") - F.col("gaps") * F.col("gaps") / n, F.lit(0.0))
    sums = sums.withColumn("squares", F.when(F.col("x_first") == F.col("x_last"), 0.0).otherwise(squares)).drop("gaps", "gap_squares")
    tested = _with_p_value(_with_statistic(sums))
    return results(
        tested, "shapiro_wilk", keys, F.col("w"), F.col("n"), p_value=F.col("p"), alpha=alpha
    )
