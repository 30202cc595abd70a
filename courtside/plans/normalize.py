"""Raw landed rows -> typed, derived, newest-snapshot processed tables.

``read_landing`` (canonical string columns) -> ``normalize_*`` (types,
season) -> ``derive_*`` (the derived columns) -> ``latest_snapshot`` ->
``write_processed``. One lazy plan per dataset; nothing runs before the
write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.coerce import to_double, to_int, to_long
from courtside.functions.labels import made_label, tier_label, true_shooting, zone_label
from courtside.operators.snapshot import latest_snapshot
from courtside.schemas import (
    DEFAULT_TIERS, DEFAULT_ZONE_BOUNDS, PLAYER_STATS, SHOT_CHARTS, TEAM_STANDINGS,
)
from courtside.sources.landing import landed_dates, read_landing

_PLAYER_DOUBLES = ("minutes_per_game", "points_per_game", "assists_per_game",
                   "rebounds_per_game", "steals_per_game", "blocks_per_game",
                   "field_goal_pct", "three_point_pct", "free_throw_pct", "efficiency_rating")
_TEAM_DOUBLES = ("win_pct", "points_per_game", "opp_points_per_game", "point_differential")
_TEAM_STRINGS = ("team_city", "team_name", "team_abbreviation", "conference", "division",
                 "home_record", "away_record", "last_10_record")
_SHOT_INTS = ("period", "minutes_remaining", "seconds_remaining", "shot_distance",
              "loc_x", "loc_y", "shot_made_flag")
_SHOT_STRINGS = ("game_id", "player_name", "team_name", "event_type", "action_type",
                 "shot_type", "shot_zone_basic", "shot_zone_area")


def _text(c: str) -> Column:
    """Text column: empty text is missing."""
    v = F.col(c).cast("string")
    return F.when(F.trim(v) != "", v)


def _season_date(df: DataFrame, season: str | None) -> list[Column]:
    """``season`` from the argument, else from the file or path (string);
    ``date`` from the path when present."""
    cols = []
    if season is not None:
        cols.append(F.lit(season).alias("season"))
    elif "season" in df.columns:
        cols.append(F.col("season").cast("string").alias("season"))
    else:
        raise KeyError("no season: pass season= or land under season=...")
    if "date" in df.columns:
        cols.append(F.col("date").cast("date").alias("date"))
    return cols


def normalize_players(df: DataFrame, season: str | None = None) -> DataFrame:
    cols = [to_long("player_id").alias("player_id"),
            _text("player_name").alias("player_name"),
            _text("team_abbreviation").alias("team_abbreviation"),
            to_int("games_played").alias("games_played")]
    cols += [to_double(c).alias(c) for c in _PLAYER_DOUBLES]
    cols += [to_double(c).alias(c) for c in ("fga", "fta") if c in df.columns]
    return df.select(*cols, *_season_date(df, season))


def normalize_standings(df: DataFrame, season: str | None = None) -> DataFrame:
    cols = [to_long("team_id").alias("team_id")]
    cols += [_text(c).alias(c) for c in _TEAM_STRINGS]
    cols += [to_int("wins").alias("wins"), to_int("losses").alias("losses")]
    cols += [to_double(c).alias(c) for c in _TEAM_DOUBLES]
    return df.select(*cols, *_season_date(df, season))


def normalize_shots(df: DataFrame, season: str | None = None) -> DataFrame:
    cols = [_text(c).alias(c) for c in _SHOT_STRINGS]
    cols += [to_long("player_id").alias("player_id"), to_long("team_id").alias("team_id")]
    cols += [to_int(c).alias(c) for c in _SHOT_INTS]
    return df.select(*cols, *_season_date(df, season))


def derive_players(df: DataFrame) -> DataFrame:
    """``true_shooting_pct`` from per-game points and attempts when the raw
    ``fga``/``fta`` columns were landed; NULL otherwise."""
    if "true_shooting_pct" in df.columns:
        return df
    if "fga" in df.columns and "fta" in df.columns:
        ts = true_shooting("points_per_game", "fga", "fta")
    else:
        ts = F.lit(None).cast("double")
    return df.withColumn("true_shooting_pct", ts)


def derive_standings(df: DataFrame, tiers=DEFAULT_TIERS) -> DataFrame:
    return df.withColumns({
        "total_games": F.col("wins") + F.col("losses"),
        "net_rating": F.col("points_per_game") - F.col("opp_points_per_game"),
        "win_pct_label": tier_label("win_pct", tiers),
    })


def derive_shots(df: DataFrame, zone_bounds=DEFAULT_ZONE_BOUNDS) -> DataFrame:
    return df.withColumns({
        "shot_zone_label": zone_label("shot_distance", zone_bounds),
        "made_label": made_label("shot_made_flag"),
    })


# Snapshot keys: a season for the league-wide tables; season and player for
# shots, because one player's file can be missing on a given day.
SNAPSHOT_KEYS = {
    "player_stats": ["season"],
    "team_standings": ["season"],
    "shot_charts": ["season", "player_id"],
}
_STEPS = {
    "player_stats": (normalize_players, derive_players, PLAYER_STATS),
    "team_standings": (normalize_standings, derive_standings, TEAM_STANDINGS),
    "shot_charts": (normalize_shots, derive_shots, SHOT_CHARTS),
}


def process(df: DataFrame, dataset: str, season: str | None = None,
            newest_only: bool = True) -> DataFrame:
    """Landed canonical strings -> processed schema (typed, derived, newest snapshot)."""
    normalize, derive, schema = _STEPS[dataset]
    out = derive(normalize(df, season))
    if newest_only and "date" in out.columns:
        keys = SNAPSHOT_KEYS[dataset]
        out = latest_snapshot(out, keys, "date", few_keys=keys == ["season"])
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def build_processed(spark: SparkSession, root: str, dataset: str,
                    season: str | None = None) -> DataFrame:
    """The processed table of one dataset straight from its landing folder. Where a
    season's newest snapshot is one date folder, only that folder is read; where each season has
    landed on one date, there is nothing to choose and the rows are read once."""
    newest_only = SNAPSHOT_KEYS[dataset] == ["season"]
    dates = landed_dates(spark, f"{root.rstrip('/')}/{dataset}", season)
    raw = read_landing(spark, root, dataset, season=season, newest_only=newest_only)
    return process(raw, dataset, newest_only=not newest_only and any(len(d) > 1 for d in dates.values()))
