"""Keep only the newest snapshot per key.

Landed files are full season-to-date snapshots, one per day; forgetting
this step multiplies every count by the number of days landed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, keys: Sequence[str], date_col: str = "date",
                    few_keys: bool = False) -> DataFrame:
    """Rows whose ``date_col`` is the newest for their ``keys``; a NULL key is a
    key like any other.

    Lazy: the newest date per key is a partial aggregate over key and date
    columns, joined back null-safely; AQE broadcasts it where it turns out
    small and splits skewed keys where not. ``few_keys`` states that the
    keys are a bounded domain (seasons: one a year), so their newest dates
    are broadcast and the table itself isn't shuffled.
    """
    keys = list(keys)
    newest = df.groupBy(*keys).agg(F.max(date_col).alias("_newest")) \
        .select(*[F.col(k).alias(f"_{k}") for k in keys], "_newest")
    if few_keys:
        newest = F.broadcast(newest)
    on = F.col(date_col).eqNullSafe(F.col("_newest"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(newest, on, "left_semi")
