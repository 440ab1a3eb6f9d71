"""Exact rounded statistics.

A rounded mean of DECIMAL(3,2) values must round once, from the exact
quotient.  Averaging in a narrow decimal rounds twice and can be off by one
hundredth at large counts, and averaging in DOUBLE depends on summation order.
So sums are kept as exact integers of hundredths and divided once, with
half-away-from-zero rounding done in integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(magnitude: Column) -> Column:
    """DECIMAL(3,2) magnitude as an exact BIGINT number of hundredths."""
    return (magnitude * 100).cast("bigint")


def rounded_quotient(total: Column, n: Column) -> Column:
    """round(total / n) to an integer, half away from zero; NULL when n = 0."""
    t = total.cast("decimal(38,0)")
    k = F.call_function("div", F.abs(t) * 2 + n, (n * 2).cast("decimal(38,0)"))
    return F.when(n > 0, F.signum(t).cast("bigint") * k)


def rounded_mean(total: Column, n: Column, scale: int) -> Column:
    """Mean rounded to ``scale`` digits as DOUBLE, from a sum already expressed
    in units of 10^-scale (e.g. hundredths for scale 2)."""
    return (rounded_quotient(total, n).cast("double") / float(10 ** scale))


def round2(x: Column) -> Column:
    """round(x, 2) for a DOUBLE using one fixed sequence of IEEE operations."""
    return F.floor(x * 100.0 + 0.5) / 100.0


def stddev_from_moments(n: Column, s1: Column, s2: Column, unit: float) -> Column:
    """Sample standard deviation from exact integer moments.

    ``s1`` = sum of k, ``s2`` = sum of k*k for integer k = value / unit.  The
    numerator n*s2 - s1^2 is exact; one division and one square root follow.
    NULL for fewer than two values.
    """
    num = (n.cast("decimal(38,0)") * s2.cast("decimal(38,0)")
           - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)"))
    den = n.cast("decimal(38,0)") * (n - 1).cast("decimal(38,0)")
    var = num.cast("double") / den.cast("double")
    return F.when(n > 1, F.sqrt(var) * unit)
