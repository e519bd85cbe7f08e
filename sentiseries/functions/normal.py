"""Standard normal quantile in column arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Coefficients of the rational approximation AS 241 (Wichura 1988,
# "The Percentage Points of the Normal Distribution"), lowest power first.
CENTRE_NUM = (
    3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
    45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727,
)
CENTRE_DEN = (
    1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
    21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610,
)
MIDDLE_NUM = (
    1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
    1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833,
    0.000774545014278341407640,
)
MIDDLE_DEN = (
    1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
    0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600,
    1.05075007164441684324e-9,
)
TAIL_NUM = (
    6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
    0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815,
    2.01033439929228813265e-7,
)
TAIL_DEN = (
    1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
    0.000786869131145613259100, 0.0000184631831751005468180, 1.42151175831644588870e-7,
    2.04426310338993978564e-15,
)


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    """Value at ``x`` of the polynomial with these coefficients, lowest power first."""
    highest, *rest = reversed(coefficients)
    return reduce(lambda total, c: total * x + F.lit(c), rest, F.lit(highest))


def with_normal_quantile(df: DataFrame, p: Column, out: str) -> DataFrame:
    """Add x with P(Z <= x) = p, for p strictly between 0 and 1.

    The polynomials' arguments are columns of their own, so each is worked out once.
    """
    share, tail = F.col("_share"), F.col("_tail")
    stepped = df.withColumn("_share", p).withColumns({
        "_centre": F.lit(0.180625) - (share - 0.5) * (share - 0.5),
        "_tail": F.sqrt(-F.log(F.least(share, 1 - share))),
    }).withColumn("_shifted", tail - F.when(tail <= 5.0, 1.6).otherwise(5.0))
    centre, shifted = F.col("_centre"), F.col("_shifted")

    def ratio(x: Column, top: tuple[float, ...], bottom: tuple[float, ...]) -> Column:
        return polynomial(x, top) / polynomial(x, bottom)

    value = (
        F.when(F.abs(share - 0.5) <= 0.425, (share - 0.5) * ratio(centre, CENTRE_NUM, CENTRE_DEN))
        .when(tail <= 5.0, F.signum(share - 0.5) * ratio(shifted, MIDDLE_NUM, MIDDLE_DEN))
        .otherwise(F.signum(share - 0.5) * ratio(shifted, TAIL_NUM, TAIL_DEN))
    )
    return stepped.withColumn(out, value).drop("_share", "_centre", "_tail", "_shifted")
