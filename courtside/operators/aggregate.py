"""Grouped rates and shares.

Both are partial + final hash aggregates: rows are combined map-side
before the shuffle, so a key holding a third of all rows costs one
partial row per task, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.rates import pct_rate


def rate_by_group(df: DataFrame, keys: Sequence[str], flag: str,
                  denominator: str = "rows", min_attempts: int | None = None,
                  attempts: str = "attempts", makes: str | None = "makes",
                  rate: str = "fg_pct", drop_null_keys: bool = False) -> DataFrame:
    """Per group: attempts, makes = SUM(flag), rate = round(makes*100/attempts, 1).

    denominator="rows" counts every row (SQL ``COUNT(*)``);
    "non_null" counts non-NULL flags only (``count(flag)``, as a mean does).
    ``min_attempts`` is the HAVING bound on attempts.
    """
    keys = list(keys)
    src = df
    if drop_null_keys:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        src = src.where(cond)
    if denominator == "rows":
        n = F.count(F.lit(1))
    elif denominator == "non_null":
        n = F.count(F.col(flag))
    else:
        raise ValueError(f"denominator must be 'rows' or 'non_null', not {denominator!r}")
    out = src.groupBy(*keys).agg(
        n.cast("bigint").alias(attempts),
        F.sum(F.col(flag)).cast("bigint").alias("__makes"),
    )
    if min_attempts is not None:
        out = out.where(F.col(attempts) >= min_attempts)
    out = out.withColumn(rate, pct_rate("__makes", attempts))
    if makes:
        out = out.withColumnRenamed("__makes", makes)
    else:
        out = out.drop("__makes")
    return out


def conditional_rate(flag: str, condition: Column) -> Column:
    """Aggregate: round(100 * mean of the non-NULL flags where the condition holds, 1);
    NULL if there is none."""
    own = F.when(condition, F.col(flag))
    return pct_rate(F.sum(own), F.count(own))


def share_of_total(df: DataFrame, count_col: str, within: Sequence[str],
                   share: str = "pct_of_shots") -> DataFrame:
    """Add round(count * 100 / SUM(count) OVER (PARTITION BY within), 1).

    Meant for already-aggregated rows: the window partitions the reduced
    rows by ``within`` (never an empty PARTITION BY, which would be a
    single-partition exchange).
    """
    within = list(within)
    if not within:
        raise ValueError("share_of_total needs at least one 'within' column")
    w = Window.partitionBy(*within)
    return df.withColumn(share, pct_rate(F.col(count_col), F.sum(count_col).over(w)))
