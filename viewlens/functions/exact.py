"""Exact integer rounding of ratios.

Means that the reports round (half up in the RFM job, half even in the
dashboard tables) are computed from exact integer numerators and
denominators, so the result never depends on floating-point summation
order or on a double rounding step. Inputs must be non-negative integers
(or decimals with scale 0); a zero denominator gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(38,0)"


def _dec(c: Column) -> Column:
    return c.cast(_EXACT)


def int_div(n: Column, d: Column) -> Column:
    """floor(n / d) for n >= 0, d > 0, exact for any size."""
    n, d = _dec(n), _dec(d)
    return ((n - F.pmod(n, d)) / d).cast("long")


def int_div_long(n: Column, d: Column) -> Column:
    """floor(n / d) for 0 <= n < 2**53 and d > 0 in long arithmetic.

    n - (n mod d) is an exact multiple of d below 2**53, so the double
    quotient is exact; cheaper per row than the decimal path of int_div.
    """
    return ((n - F.pmod(n, d)) / d).cast("long")


def ratio_half_up(n: Column, d: Column, scale: int = 0) -> Column:
    """n / d rounded half up to ``scale`` decimals, as double."""
    dd = _dec(d)
    num = _dec(n) * F.lit(2 * 10**scale) + dd
    q = int_div(num, dd * F.lit(2))
    return F.when(dd > 0, q.cast("double") / F.lit(float(10**scale)))


def ratio_half_even(n: Column, d: Column, scale: int = 0) -> Column:
    """n / d rounded half to even to ``scale`` decimals, as double."""
    dd = _dec(d)
    num = _dec(n) * F.lit(10**scale)
    r = F.pmod(num, dd)
    q = int_div(num, dd)
    bump = (r * F.lit(2) > dd) | ((r * F.lit(2) == dd) & (F.pmod(q, F.lit(2)) == 1))
    q = q + F.when(bump, F.lit(1)).otherwise(F.lit(0))
    return F.when(dd > 0, q.cast("double") / F.lit(float(10**scale)))


def ratio(n: Column, d: Column) -> Column:
    """Plain n / d as double, NULL on a zero denominator."""
    return F.when(d != 0, n.cast("double") / d.cast("double"))


def cents(amount: Column) -> Column:
    """A decimal amount with two decimals as an exact integer count of cents."""
    return (amount * F.lit(100)).cast(_EXACT)
