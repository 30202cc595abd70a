"""Column-level helpers. Every helper returns a ``Column`` built from
built-in functions, so expressions stay JVM-side inside codegen."""

from courtside.functions.coerce import to_double, to_int, to_long, nan_to_null
from courtside.functions.labels import tier_label, zone_label, made_label, true_shooting
from courtside.functions.rates import pct_rate
from courtside.functions.text import (
    percent_text, signed_text, record_text, one_decimal_text, thousands_text,
)

__all__ = [
    "to_double", "to_int", "to_long", "nan_to_null",
    "tier_label", "zone_label", "made_label", "true_shooting",
    "pct_rate",
    "percent_text", "signed_text", "record_text", "one_decimal_text",
    "thousands_text",
]
