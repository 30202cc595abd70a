"""Shooting by zone, hot zones, shot-volume shares, clutch shooting.

All are partial + final hash aggregates keyed by player and zone; the
share window runs on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.aggregate import rate_by_group, share_of_total
from courtside.schemas import CLUTCH_MAX_MINUTES_REMAINING, CLUTCH_PERIOD


def _season(shots: DataFrame, season: str) -> DataFrame:
    return shots.where(F.col("season") == season)


def clutch_condition(period: int = CLUTCH_PERIOD,
                     max_minutes: int = CLUTCH_MAX_MINUTES_REMAINING):
    """4th quarter with at most 5 whole minutes left (5:59 counts; overtime does not)."""
    return (F.col("period") == period) & (F.col("minutes_remaining") <= max_minutes)


def s_zone(shots: DataFrame, season: str) -> DataFrame:
    """Attempts, makes and FG% per player and distance bucket."""
    df = rate_by_group(_season(shots, season), ["player_name", "shot_zone_label", "season"],
                       "shot_made_flag", denominator="rows")
    return df.select("player_name", "shot_zone_label", "attempts", "makes", "fg_pct", "season") \
        .orderBy(F.col("player_name").asc_nulls_last(), F.col("fg_pct").desc_nulls_last(),
                 F.col("shot_zone_label").asc_nulls_last())


def s_hot(shots: DataFrame, season: str, min_attempts: int = 10) -> DataFrame:
    """Zones (basic x area) where each player shoots best, with enough attempts."""
    df = _season(shots, season).where(F.col("shot_made_flag").isNotNull())
    df = rate_by_group(df, ["player_name", "shot_zone_basic", "shot_zone_area"],
                       "shot_made_flag", denominator="rows", min_attempts=min_attempts,
                       makes=None)
    return df.orderBy(F.col("player_name").asc_nulls_last(), F.col("fg_pct").desc_nulls_last(),
                      F.col("shot_zone_basic").asc_nulls_last(), F.col("shot_zone_area").asc_nulls_last())


def s_share(shots: DataFrame, season: str) -> DataFrame:
    """Volume by distance bucket and its share of the player's attempts."""
    df = rate_by_group(_season(shots, season), ["player_name", "shot_zone_label"],
                       "shot_made_flag", attempts="total_attempts", makes="total_makes")
    df = share_of_total(df, "total_attempts", ["player_name"], share="pct_of_shots")
    return df.orderBy(F.col("player_name").asc_nulls_last(),
                      F.col("total_attempts").desc_nulls_last(),
                      F.col("shot_zone_label").asc_nulls_last())


def s_clutch(shots: DataFrame, season: str, min_attempts: int = 5) -> DataFrame:
    """Clutch shooting per player."""
    df = _season(shots, season).where(clutch_condition())
    df = rate_by_group(df, ["player_name"], "shot_made_flag", min_attempts=min_attempts,
                       attempts="clutch_attempts", makes="clutch_makes", rate="clutch_fg_pct")
    return df.orderBy(F.col("clutch_fg_pct").desc_nulls_last(),
                      F.col("player_name").asc_nulls_last())
