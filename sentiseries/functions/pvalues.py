"""Tail probabilities of test statistics.

The functions see finished result rows only, one per test, so they are plain
Python on a few numbers behind a pandas UDF.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

# Sent to the Python workers by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_PRECISION = 1e-15
_MOST_TERMS = 2_000_000
# Both parameters above this: the expansion is closer than the continued fraction.
_LARGE = 1e8
EXACT_FEW = 8
EXACT_LIST = 1_000_000
# The smaller sample of a rank sum whose counts are integrated.
EXACT_MOST = 1_000_000


def normal_two_sided(z: float) -> float:
    """P(|Z| >= |z|)."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def normal_upper(z: float) -> float:
    """P(Z >= z)."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _fraction(b0: float, terms: Callable[[int], tuple[float, float]]) -> float:
    """Continued fraction b0 + a1/(b1 + a2/(b2 + ...)) by Lentz's method; NaN if it does not settle."""
    value = b0 or _TINY
    c, d = value, 0.0
    for j in range(1, _MOST_TERMS):
        a, b = terms(j)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        value *= c * d
        if abs(c * d - 1.0) < _PRECISION:
            return value
    return math.nan


def _log1p_rest(y: float) -> float:
    """log(1 + y) - y without loss of digits for small y."""
    if abs(y) > 0.1:
        return math.log1p(y) - y
    total, power = 0.0, y
    for j in range(2, 40):
        power *= -y
        total += power / j
    return total


def _stirling_rest(a: float) -> float:
    """log Gamma(a) less Stirling's formula."""
    if a < 20.0:
        return math.lgamma(a) - ((a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi))
    s = 1.0 / (a * a)
    return (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / a


def chi2_upper(x: float, dof: float) -> float:
    """P(chi-squared with ``dof`` degrees of freedom >= x)."""
    a, t = dof / 2.0, x / 2.0
    if t <= 0:
        return 1.0
    # t^a e^-t / Gamma(a), with the large terms taken out
    scale = math.exp(a * _log1p_rest((t - a) / a) - _stirling_rest(a)) * math.sqrt(a / (2 * math.pi))
    if t < a + 1.0:
        term = total = 1.0 / a
        step = a
        while term > total * _PRECISION:
            if step - a > _MOST_TERMS:
                return math.nan
            step += 1.0
            term *= t / step
            total += term
        return max(0.0, 1.0 - scale * total)
    return scale / _fraction(t + 1.0 - a, lambda j: (j * (a - j), t + 2 * j + 1.0 - a))


def beta_lower(x: float, a: float, b: float, y: float | None = None) -> float:
    """Regularized incomplete beta function I_x(a, b); ``y`` is 1 - x where known better.

    A continued fraction; for two large parameters the uniform expansion in the
    complementary error function, whose first term left out is below 1e-12 there; for a
    large one far above the other the gamma distribution it tends to, 1e-10 away at most.
    """
    y = 1.0 - x if y is None else y
    if x <= 0.0 or y <= 0.0:
        return float(y <= 0.0)
    if max(a, b) > _LARGE and min(a, b) < 1e-5 * max(a, b):
        if a > b:
            return chi2_upper(-2.0 * (a + (b - 1.0) / 2.0) * math.log1p(-y), 2.0 * b)
        return 1.0 - chi2_upper(-2.0 * (b + (a - 1.0) / 2.0) * math.log1p(-x), 2.0 * a)
    if x * (b + 1.0) > y * (a + 1.0):
        return 1.0 - _beta_tail(y, b, a, x)
    return _beta_tail(x, a, b, y)


def _beta_tail(x: float, a: float, b: float, y: float) -> float:
    n = a + b
    middle, rest = a / n, b / n
    gap = (x * b - y * a) / n  # x - middle
    # the logarithm of (x / middle)^a (y / rest)^b, its linear parts cancelled
    log_ratio = a * _log1p_rest(gap / middle) + b * _log1p_rest(-gap / rest)
    if min(a, b) > _LARGE:
        eta = math.copysign(math.sqrt(max(-2.0 * log_ratio / n, 0.0)), gap)
        if abs(eta) > 1e-5:
            first = 1.0 / eta - math.sqrt(middle * rest) / gap
        else:
            first = (rest - middle) / (3.0 * math.sqrt(middle * rest))
        return 0.5 * math.erfc(-eta * math.sqrt(n / 2.0)) + math.exp(log_ratio) / math.sqrt(2 * math.pi * n) * first

    def terms(j: int) -> tuple[float, float]:
        half, odd = divmod(j, 2)
        if odd:
            top = -(a + half) * (a + b + half)
        else:
            top = half * (b - half)
        return top * x / ((a + j - 1) * (a + j)), 1.0

    rests = _stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b)
    front = math.exp(log_ratio + rests) * math.sqrt(a * rest / (2 * math.pi))
    return front / (a * _fraction(1.0, terms))


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    return beta_lower(dof / (dof + t * t), dof / 2.0, 0.5, t * t / (dof + t * t))


def f_upper(f: float, dof1: float, dof2: float) -> float:
    """P(F >= f) for the F distribution."""
    whole = dof2 + dof1 * f
    return beta_lower(dof2 / whole, dof2 / 2.0, dof1 / 2.0, dof1 * f / whole)


def _restricted_sums(total: int, few: int) -> int:
    """Ways to write numbers up to ``total`` as sums of 1 to ``few``, in any number of each.

    This is a polynomial of degree ``few`` along every step of the numbers' least common
    multiple, so it is counted for small totals only and continued exactly.
    """
    step = math.lcm(*range(1, few + 1))
    base, steps = total % step, total // step
    top = base + step * min(few, steps)
    ways = [1] * (top + 1)  # one kind of 1 for each number up to the total
    for part in range(1, few + 1):
        for j in range(part, top + 1):
            ways[j] += ways[j - part]
    if steps <= few:
        return ways[total]
    value = Fraction(0)
    for i in range(few + 1):
        weight = Fraction(ways[base + step * i])
        for k in range(few + 1):
            if k != i:
                weight *= Fraction(steps - k, i - k)
        value += weight
    return int(value)


def _rank_sum_tail(reach: int, few: int, many: int) -> float:
    """P(U <= reach) for a reach so long that its counts cannot be listed.

    The count is a coefficient of G(z) / (1 - z), G being the Gaussian binomial, so the
    probability is the mean of G(z) / (arrangements z^reach (1 - z)) over a circle |z| = e^s.
    On the circle through the saddle point the integrand is a peak of width 1 / sigma around
    the positive axis, and equal steps of 0.17 / sigma give the mean within e^-37 of
    itself; points are added until they no longer count, at 1e-18 of the peak. Further peaks,
    near other roots of unity, stay below that for the samples this is meant for (more than
    ``EXACT_FEW`` values, a reach above ``EXACT_LIST``): half of the factors of G are as small
    as the larger sample's reciprocal there. Relative error about 1e-11.
    """
    sizes = np.arange(1, few + 1, dtype=float)
    longer = sizes + many
    with np.errstate(over="ignore"):

        def slope(s: float) -> float:
            inner = sizes / np.expm1(-sizes * s) - longer / np.expm1(-longer * s)
            return float(inner.sum()) - reach + 1.0 / math.expm1(-s)

        low, high = math.log(1e-25), math.log(50.0)
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if slope(-math.exp(middle)) > 0 else (low, middle)
        s = -math.exp(low)
        curve = (sizes / np.sinh(sizes * s / 2)) ** 2 - (longer / np.sinh(longer * s / 2)) ** 2
        sigma = math.sqrt(float(curve.sum()) / 4 + (0.5 / math.sinh(s / 2)) ** 2)
    step = 0.17 / sigma
    points = 64
    logs = np.log(sizes / longer)

    def heights(first: int) -> np.ndarray:
        w = s + 1j * step * np.arange(first, first + points)
        total = -reach * w - np.log(-np.expm1(w))
        for at in range(0, few, 4096):
            part = slice(at, at + 4096)
            ratio = np.expm1(np.outer(longer[part], w)) / np.expm1(np.outer(sizes[part], w))
            total += (np.log(ratio) + logs[part, None]).sum(axis=0)
        return total

    first, total, peak = 0, 0.0, None
    while first * step < math.pi:
        logarithms = heights(first)
        if peak is None:
            peak = logarithms[0].real
            total -= 0.5
        values = np.exp(logarithms - peak)
        total += float(values.real.sum())
        first += points
        if np.abs(values[-8:]).max() < 1e-18:
            break
    return math.exp(peak) * total * step / math.pi


def rank_sum_exact(u: float, n1: float, n2: float) -> float:
    """Two-sided P of a U at least as extreme, without ties.

    The arrangements of each rank sum are the coefficients of the Gaussian binomial
    [n1 + n2 choose n1], a product of (1 - q^m) / (1 - q^i). For up to ``EXACT_FEW``
    values in the smaller sample the numerator's terms are summed over a count that
    needs a list of fixed length; beyond, coefficients are built up to the smaller
    tail, or where that takes more than ``EXACT_LIST`` of them their sum is integrated
    (``_rank_sum_tail``). NaN above ``EXACT_MOST`` values in the smaller sample.
    """
    few, many = sorted((int(n1), int(n2)))
    reach = int(min(u, n1 * n2 - u))
    if few > EXACT_FEW and reach > EXACT_LIST:
        return min(1.0, 2.0 * _rank_sum_tail(reach, few, many)) if few <= EXACT_MOST else math.nan
    arrangements = math.comb(few + many, few)
    if few <= EXACT_FEW:
        signs = {0: 1}
        for i in range(1, few + 1):
            for shift, sign in list(signs.items()):
                signs[shift + many + i] = signs.get(shift + many + i, 0) - sign
        tail = sum(sign * _restricted_sums(reach - shift, few) for shift, sign in signs.items() if shift <= reach)
        return float(min(1, Fraction(2 * tail, arrangements)))
    ways = [1] + [0] * reach
    for i in range(1, few + 1):
        m = many + i
        for j in range(reach, m - 1, -1):
            ways[j] -= ways[j - m]
        for j in range(i, reach + 1):
            ways[j] += ways[j - i]
    return float(min(1, Fraction(2 * sum(ways), arrangements)))


def _column_function(probability: Callable[..., float]):
    @F.pandas_udf("double")
    def apply(*arguments: pd.Series) -> pd.Series:
        rows = zip(*arguments)
        values = [None if any(map(pd.isna, row)) else probability(*row) for row in rows]
        # what did not settle has no probability
        return pd.Series([None if v is None or v != v else v for v in values], dtype=object)

    return apply


def two_sided_normal_p(z):
    return _column_function(normal_two_sided)(z)


def upper_normal_p(z):
    return _column_function(normal_upper)(z)


def chi2_p(x, dof):
    return _column_function(chi2_upper)(x, dof)


def t_p(t, dof):
    return _column_function(t_two_sided)(t, dof)


def f_p(f, dof1, dof2):
    return _column_function(f_upper)(f, dof1, dof2)


def exact_rank_sum_p(u, n1, n2):
    return _column_function(rank_sum_exact)(u, n1, n2)
