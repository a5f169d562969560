"""Exact decimal arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def percentage(numer, denom, scale: int = 2) -> Column:
    """round(100 * numer / denom, scale) with exact decimal division.

    ``numer`` and ``denom`` are integral.  The quotient is computed as
    DECIMAL(38,18) (a plain ``DECIMAL/int`` division in Spark keeps only six
    fractional digits and mis-rounds values such as 107/366); rounding is
    half away from zero.  A zero denominator gives NULL.
    """
    n = (_c(numer).cast("bigint") * 100).cast("decimal(30,10)")
    d = F.nullif(_c(denom).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(n / d, scale)


def relative_change(current, previous, scale: int = 2) -> Column:
    """round(100 * (current - previous) / previous, scale); NULL if previous is 0/NULL."""
    return percentage(_c(current) - _c(previous), previous, scale)
