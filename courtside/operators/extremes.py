"""Argmax / argmin returning a label, the first row in display order
winning ties — without numbering rows.

The display order is encoded as a sortable struct (``display_key``), so
"first in display order" is ``min_by(label, key)``: a plain partial +
final aggregate, with no window and no single-partition exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def display_key(by, descending: bool = True, tiebreak: Sequence = ()) -> Column:
    """A struct that sorts ascending exactly like
    ``ORDER BY by [DESC] NULLS LAST, tiebreak... NULLS LAST``.
    ``by`` must be numeric when descending (it is negated)."""
    fields = []
    b = _c(by)
    fields += [F.isnull(b), -b if descending else b]
    for t in tiebreak:
        c = _c(t)
        fields += [F.isnull(c), c]
    return F.struct(*fields)


def first_in_order(label, key: Column) -> Column:
    """Aggregate: ``label`` of the first row by ``key`` (see ``display_key``)."""
    return F.min_by(_c(label), key)


def arg_extreme(label, value, key: Column, largest: bool = True) -> Column:
    """Aggregate: ``label`` of the row with the largest (smallest) ``value``;
    rows with NULL or NaN values are skipped; among equal values the first
    row by ``key`` wins."""
    v = _c(value)
    ok = v.isNotNull() & ~F.isnan(v)
    order = F.struct(-v if largest else v, key)
    return F.min_by(F.when(ok, _c(label)), F.when(ok, order))
