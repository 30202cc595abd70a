"""Display text built JVM-side. Numbers are rounded half-up first, so
the printed digits are those of the rounded value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def one_decimal_text(value, suffix: str = "") -> Column:
    """'%.1f' of round(value, 1), with a suffix; NULL stays NULL."""
    return F.format_string("%.1f" + suffix.replace("%", "%%"), F.round(_c(value), 1))


def percent_text(value, scale: float = 100.0) -> Column:
    """Fraction (or already-percent value with scale=1) as '53.3%'."""
    v = _c(value) * F.lit(scale) if scale != 1 else _c(value)
    return F.when(v.isNotNull(), one_decimal_text(v, "%"))


def signed_text(value) -> Column:
    """'+3.2' / '-1.5'."""
    return F.format_string("%+.1f", F.round(_c(value), 1))


def record_text(wins, losses) -> Column:
    """'W-L'."""
    return F.format_string("%d-%d", _c(wins), _c(losses))


def thousands_text(value) -> Column:
    """'1,234'."""
    return F.format_string("%,d", _c(value))
