"""Percent rates with explicit denominators and exact half-up rounding.

``pct_rate`` mirrors ``ROUND(SUM(flag) * 100.0 / COUNT(*), 1)`` of ANSI SQL:
the arithmetic is decimal, so rounding sees the exact quotient, never
float noise; the rounded value is returned as DOUBLE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_rate(numerator, denominator, digits: int = 1) -> Column:
    """round(numerator * 100.0 / denominator, digits) in exact decimal; NULL on 0/NULL."""
    num = _c(numerator).cast("decimal(20,0)") * F.lit(Decimal("100.0"))
    return F.round(F.try_divide(num, _c(denominator).cast("decimal(20,0)")), digits).cast("double")
