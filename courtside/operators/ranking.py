"""Positions inside a group (playoff seeds, 1-based display positions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.operators.topk import order_columns


def seed_within(df: DataFrame, group: Sequence[str] | str, by, tiebreak: Sequence = (),
                k: int | None = None, name: str = "conference_seed",
                descending: bool = True) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group ORDER BY by DESC NULLS LAST, tiebreak)
    as BIGINT, keeping seeds <= k when k is given.

    With k, Catalyst inserts a ``WindowGroupLimit`` before and after the
    shuffle, so each task forwards at most k rows per group and a hot group
    never lands whole in one task. Without k every row of a group is
    ranked in one task: ``positions`` numbers one large group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order_columns(by, descending, tiebreak))
    out = df.withColumn(name, F.row_number().over(w).cast("bigint"))
    if k is not None:
        out = out.where(F.col(name) <= k)
    return out


def positions(df: DataFrame, by: str, tiebreak: Sequence = (), name: str = "position",
              descending: bool = True, ranges: int = 64) -> DataFrame:
    """1-based places of all rows in the order of ``by`` and ``tiebreak``, as BIGINT.

    Approximate quantiles cut ``by`` into ``ranges`` value ranges; rows are
    numbered inside their range, and a count per range says how many rows
    stand before it. Places are exact, and no task holds more than a range. The input is
    evaluated three times (cuts, counts, rows): write or persist a costly one first, and number a
    frame that is small by nature with ``seed_within``.
    """
    cuts = df.agg(F.percentile_approx(by, [i / ranges for i in range(1, ranges)]).alias("c")).scalar()
    df = df.withColumn("_cuts", F.coalesce(cuts, F.array().cast("array<double>")))
    beyond = F.filter("_cuts", lambda c: c > F.col(by) if descending else c < F.col(by))
    cut = df.withColumn("_range", F.when(F.col(by).isNull(), F.lit(ranges)).otherwise(F.size(beyond)))
    inside = cut.withColumn("_own", F.row_number().over(
        Window.partitionBy("_range").orderBy(*order_columns(by, descending, tiebreak))))
    # at most ``ranges`` + 1 rows
    before = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(
            Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (inside.join(F.broadcast(before), F.col("_range") == F.col("_r"))
            .withColumn(name, (F.col("_own") + F.col("_before")).cast("bigint"))
            .drop("_cuts", "_range", "_own", "_r", "_before"))
