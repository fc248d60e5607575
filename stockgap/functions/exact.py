"""Exact arithmetic on means kept as (sum, count) pairs of longs.

A mean is never divided out before it is compared or rounded: comparisons
cross-multiply, rounding uses integer division.  Every helper returns a
plain ``Column`` built from JVM expressions, so it stays inside whole-stage
codegen.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _long(x) -> Column:
    return _c(x).cast("bigint")


def _wide(x) -> Column:
    """Exact integer wide enough for products of sums and counts."""
    return _c(x).cast("decimal(38,0)")


def mean_ge(total, count, k: Fraction) -> Column:
    """``total / count >= k`` exactly; NULL when ``count`` is 0 (empty frame)."""
    k = Fraction(k)
    cond = _wide(total) * k.denominator >= _wide(count) * k.numerator
    return F.when(_c(count) > 0, cond)


def value_ge_k_mean(value, total, count, k: Fraction) -> Column:
    """``value >= k * total / count`` exactly; NULL when ``count`` is 0."""
    k = Fraction(k)
    cond = _wide(value) * _wide(count) * k.denominator >= _wide(total) * k.numerator
    return F.when(_c(count) > 0, cond)


def mean_le_k_mean(t1, n1, t2, n2, k: Fraction) -> Column:
    """``t1/n1 <= k * t2/n2`` exactly; NULL when either count is 0."""
    k = Fraction(k)
    cond = _wide(t1) * _wide(n2) * k.denominator <= _wide(t2) * _wide(n1) * k.numerator
    return F.when((_c(n1) > 0) & (_c(n2) > 0), cond)


def mean_ge_k_mean(t1, n1, t2, n2, k: Fraction) -> Column:
    """``t1/n1 >= k * t2/n2`` exactly; NULL when either count is 0."""
    k = Fraction(k)
    cond = _wide(t1) * _wide(n2) * k.denominator >= _wide(t2) * _wide(n1) * k.numerator
    return F.when((_c(n1) > 0) & (_c(n2) > 0), cond)


def idiv(a, b) -> Column:
    """``floor(a / b)`` of non-negative wide integers, exact over the whole
    38 digits (the ``div`` operator returns a bigint and would overflow)."""
    a, b = _wide(a), _wide(b)
    return ((a - a % b) / b).cast("decimal(38,0)")


def round_ratio(num, den, digits: int = 0) -> Column:
    """Round the ratio ``num/den`` (``den > 0``) half away from zero.

    ``digits=0`` gives a bigint, ``digits>0`` a double equal to an integer
    divided by ``10**digits`` (so two engines produce the same IEEE value).
    NULL when ``den`` is 0 or NULL.
    """
    scale = 10 ** digits
    den_wide = F.nullif(_wide(den), F.lit(0).cast("decimal(38,0)"))
    size = idiv(F.abs(_wide(num)) * (2 * scale) + den_wide, den_wide * 2)
    q = F.when(_c(num) < 0, -size).otherwise(size)
    if digits == 0:
        return q.cast("bigint")
    return q.cast("double") / F.lit(float(scale))


def sqrt_estimate(quad) -> Column:
    """A double's estimate of the ``k`` of :func:`round_sqrt`, off by one at most."""
    return F.floor((F.sqrt(_wide(quad).cast("double")) + 1) / 2).cast("bigint")


def round_sqrt(quad, digits: int = 1, estimate=None) -> Column:
    """``sqrt(x)`` rounded half away from zero to ``digits``, exactly, given
    the wide integer ``quad = floor(4 * 100**digits * x)``; NULL for NULL.

    With ``s = 10**digits`` the rounded value is ``k / s`` for the largest
    ``k`` with ``(2k - 1)^2 <= 4 s^2 x``; the left side is an integer, so the
    floor decides it.  A double estimate of ``k`` is corrected by one step;
    ``estimate`` is a column that holds :func:`sqrt_estimate` already.
    """
    q = _wide(quad)
    est = sqrt_estimate(quad) if estimate is None else _c(estimate)

    def odd_square(k):
        return (F.lit(2) * k - 1).cast("decimal(19,0)") * (F.lit(2) * k - 1).cast("decimal(19,0)")

    k = (F.when((est > 0) & (odd_square(est) > q), est - 1)
         .when(odd_square(est + 1) <= q, est + 1).otherwise(est))
    return k.cast("double") / F.lit(float(10 ** digits))


def round_sqrt_ratio(num, den, digits: int = 1) -> Column:
    """``sqrt(num / den)`` rounded half away from zero, for integers
    ``num >= 0``, ``den > 0``; NULL when ``den`` is 0 or NULL.  Exact while
    ``4 * 100**digits * num`` has at most 38 digits."""
    d = F.nullif(_wide(den), F.lit(0).cast("decimal(38,0)"))
    return round_sqrt(idiv(_wide(num) * (4 * 100 ** digits), d), digits)
