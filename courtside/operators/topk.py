"""Top-k / bottom-k with NULLs always last and explicit tiebreaks.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task
keeps its own k best rows and one final merge sees k x tasks rows, so no
full sort or shuffle of the input happens, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def order_columns(by, descending: bool = True, tiebreak: Sequence = ()) -> list[Column]:
    """Sort keys: ``by`` in the given direction, then tiebreaks ascending;
    NULLs last for every key (Spark's ascending default puts them first)."""
    keys = []
    for b in _as_list(by):
        c = F.col(b) if isinstance(b, str) else b
        keys.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    for t in _as_list(tiebreak):
        c = F.col(t) if isinstance(t, str) else t
        keys.append(c.asc_nulls_last())
    return keys


def top_k(df: DataFrame, by, k: int | None, descending: bool = True,
          tiebreak: Sequence = ()) -> DataFrame:
    """First k rows by ``by``; k=None gives the full sort."""
    out = df.orderBy(*order_columns(by, descending, tiebreak))
    return out if k is None else out.limit(k)
