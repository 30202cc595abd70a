"""Fixed schemas of the processed tables and the fixed values that must
equal the upstream feed's for right results.

Processed tables are typed once, at normalization; queries never cast.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the upstream feed and its landed files)
# ---------------------------------------------------------------------------

# Upstream player columns kept at landing, and their canonical names.
# PLAYER_ID is kept under its upstream (upper-case) name when landed.
PLAYER_COLUMNS = {
    "player_id": ["player_id"],
    "player_name": ["player_name", "PLAYER"],
    "team_abbreviation": ["team_abbreviation", "TEAM"],
    "games_played": ["games_played", "GP"],
    "minutes_per_game": ["minutes_per_game", "MIN"],
    "points_per_game": ["points_per_game", "PTS"],
    "assists_per_game": ["assists_per_game", "AST"],
    "rebounds_per_game": ["rebounds_per_game", "REB"],
    "steals_per_game": ["steals_per_game", "STL"],
    "blocks_per_game": ["blocks_per_game", "BLK"],
    "field_goal_pct": ["field_goal_pct", "FG_PCT"],
    "three_point_pct": ["three_point_pct", "FG3_PCT"],
    "free_throw_pct": ["free_throw_pct", "FT_PCT"],
    "efficiency_rating": ["efficiency_rating", "EFF"],
}

# Standings headers drift between feed versions; first candidate found
# (case-insensitive) wins. Canonical name first, then upstream candidates.
STANDINGS_COLUMNS = {
    "team_id": ["team_id", "TeamID"],
    "team_city": ["team_city", "TeamCity"],
    "team_name": ["team_name", "TeamName"],
    "team_abbreviation": ["team_abbreviation", "TeamAbbreviation", "TeamSlug"],
    "conference": ["conference", "Conference"],
    "division": ["division", "Division"],
    "wins": ["wins", "WINS", "W"],
    "losses": ["losses", "LOSSES", "L"],
    "win_pct": ["win_pct", "WinPCT", "PCT"],
    "home_record": ["home_record", "HOME"],
    "away_record": ["away_record", "ROAD", "AWAY"],
    "last_10_record": ["last_10_record", "L10"],
    "points_per_game": ["points_per_game", "PointsPG", "PPG"],
    "opp_points_per_game": ["opp_points_per_game", "OppPointsPG", "OppPPG"],
    "point_differential": ["point_differential", "DiffPointsPG", "DIFF"],
}

# Shot columns kept at landing; upstream names are these in upper case.
SHOT_COLUMNS = [
    "game_id", "player_id", "player_name", "team_id", "team_name",
    "period", "minutes_remaining", "seconds_remaining",
    "event_type", "action_type", "shot_type", "shot_zone_basic",
    "shot_zone_area", "shot_distance", "loc_x", "loc_y", "shot_made_flag",
]

# Literal values used by the queries.
CONFERENCES = ("East", "West")
THREE_POINT_SHOT_TYPE = "3PT Field Goal"
MADE_LABEL, MISSED_LABEL = "Made", "Missed"
CLUTCH_PERIOD = 4
CLUTCH_MAX_MINUTES_REMAINING = 5

# ---------------------------------------------------------------------------
# Definitions of our own for columns the processed tables need but the
# upstream feed never defines. Cut points are parameters so a true
# definition can replace them.
# ---------------------------------------------------------------------------

# win_pct_label: (lower bound inclusive, label), checked top-down.
DEFAULT_TIERS = ((0.6, "Elite"), (0.5, "Winning"), (0.4, "Bubble"))
DEFAULT_TIER_ELSE = "Rebuilding"

# shot_zone_label: (upper bound exclusive on shot_distance, label).
DEFAULT_ZONE_BOUNDS = ((8, "Close"), (16, "Mid"), (23, "Long two"))
DEFAULT_ZONE_ELSE = "Three"

# ---------------------------------------------------------------------------
# Processed table schemas
# ---------------------------------------------------------------------------

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PLAYER_STATS = _schema([
    ("player_id", _L), ("player_name", _S), ("team_abbreviation", _S),
    ("games_played", _I),
    ("minutes_per_game", _D), ("points_per_game", _D), ("assists_per_game", _D),
    ("rebounds_per_game", _D), ("steals_per_game", _D), ("blocks_per_game", _D),
    ("field_goal_pct", _D), ("three_point_pct", _D), ("free_throw_pct", _D),
    ("efficiency_rating", _D), ("true_shooting_pct", _D),
    ("season", _S),
])

TEAM_STANDINGS = _schema([
    ("team_id", _L), ("team_city", _S), ("team_name", _S), ("team_abbreviation", _S),
    ("conference", _S), ("division", _S),
    ("wins", _I), ("losses", _I), ("total_games", _I),
    ("win_pct", _D), ("win_pct_label", _S),
    ("home_record", _S), ("away_record", _S), ("last_10_record", _S),
    ("points_per_game", _D), ("opp_points_per_game", _D),
    ("point_differential", _D), ("net_rating", _D),
    ("season", _S),
])

SHOT_CHARTS = _schema([
    ("game_id", _S), ("player_id", _L), ("player_name", _S),
    ("team_id", _L), ("team_name", _S),
    ("period", _I), ("minutes_remaining", _I), ("seconds_remaining", _I),
    ("event_type", _S), ("action_type", _S), ("shot_type", _S),
    ("shot_zone_basic", _S), ("shot_zone_area", _S),
    ("shot_distance", _I), ("loc_x", _I), ("loc_y", _I), ("shot_made_flag", _I),
    ("shot_zone_label", _S), ("made_label", _S),
    ("season", _S),
])

PROCESSED = {
    "player_stats": PLAYER_STATS,
    "team_standings": TEAM_STANDINGS,
    "shot_charts": SHOT_CHARTS,
}

# Raw (landed) column lists, canonical names, per dataset.
RAW_COLUMNS = {
    "player_stats": list(PLAYER_COLUMNS),
    "team_standings": list(STANDINGS_COLUMNS),
    "shot_charts": list(SHOT_COLUMNS),
}
