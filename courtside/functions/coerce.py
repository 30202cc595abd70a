"""Text-to-number coercion: bad text becomes NULL, the row is kept.

ANSI mode raises on ``CAST('' AS DOUBLE)`` and on ``CAST('12.0' AS INT)``,
so everything goes through ``try_cast``; integers written as float text
(``"20.0"``) pass through DOUBLE where they are no whole-number text. ``try_cast('nan' AS DOUBLE)`` is
NaN, which would win every ``max`` and poison every ``avg``: NaN is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    c = _c(x)
    return F.when(~F.isnan(c), c)


def to_double(x) -> Column:
    c = F.trim(_c(x).cast("string")).try_cast("double")
    return nan_to_null(c)


def to_long(x) -> Column:
    """Whole-number text exactly (ids beyond 2^53 keep their value); float text through DOUBLE."""
    text = F.trim(_c(x).cast("string"))
    return F.coalesce(text.try_cast("bigint"), to_double(x).try_cast("bigint"))


def to_int(x) -> Column:
    return to_long(x).try_cast("int")


def without_nan(df):
    """The frame with NaN as NULL in its floating-point columns: NaN would win every ``max``."""
    return df.select(*[nan_to_null(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
