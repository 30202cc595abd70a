"""Player leader boards and threshold filters (the player SQL templates).

Each query filters one season first (partition pruning on a processed
table partitioned by season), then ranks with a bounded top-k. Output
columns are SQL expression text: one parse on the JVM per projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.topk import top_k

# Tiebreak appended to every ranking: the source has none.
TIEBREAK = ("player_name", "player_id")


def _season(players: DataFrame, season: str, min_games: int | None) -> DataFrame:
    df = players.where(F.col("season") == season)
    if min_games is not None:
        df = df.where(F.col("games_played") >= min_games)
    return df


def p_top20(players: DataFrame, season: str, min_games: int = 20, k: int = 20) -> DataFrame:
    """Top scorers with the full stat line."""
    df = top_k(_season(players, season, min_games), "points_per_game", k, tiebreak=TIEBREAK)
    return df.selectExpr(
        "player_name", "team_abbreviation", "games_played",
        "round(points_per_game, 1) AS ppg",
        "round(assists_per_game, 1) AS apg",
        "round(rebounds_per_game, 1) AS rpg",
        "round(steals_per_game, 1) AS spg",
        "round(blocks_per_game, 1) AS bpg",
        "round(field_goal_pct * 100, 1) AS fg_pct",
        "round(three_point_pct * 100, 1) AS three_pct",
        "round(free_throw_pct * 100, 1) AS ft_pct",
        "round(true_shooting_pct * 100, 1) AS ts_pct",
        "round(efficiency_rating, 1) AS efficiency",
        "season",
    )


def p_triple(players: DataFrame, season: str, min_points: float = 20,
             min_assists: float = 5, min_rebounds: float = 5) -> DataFrame:
    """Players averaging at least points / assists / rebounds (20-5-5)."""
    df = players.where((F.col("season") == season)
                       & (F.col("points_per_game") >= min_points)
                       & (F.col("assists_per_game") >= min_assists)
                       & (F.col("rebounds_per_game") >= min_rebounds))
    return top_k(df, "points_per_game", None, tiebreak=TIEBREAK).selectExpr(
        "player_name", "team_abbreviation",
        "round(points_per_game, 1) AS ppg",
        "round(assists_per_game, 1) AS apg",
        "round(rebounds_per_game, 1) AS rpg",
        "round(efficiency_rating, 1) AS efficiency",
    )


def p_eff(players: DataFrame, season: str, min_games: int = 20, k: int = 15) -> DataFrame:
    """Efficiency leaders."""
    df = top_k(_season(players, season, min_games), "efficiency_rating", k, tiebreak=TIEBREAK)
    return df.selectExpr(
        "player_name", "team_abbreviation", "games_played",
        "round(efficiency_rating, 1) AS efficiency",
        "round(true_shooting_pct * 100, 1) AS ts_pct",
        "round(points_per_game, 1) AS ppg",
    )


def p_three(players: DataFrame, season: str, min_games: int = 20, k: int = 15) -> DataFrame:
    """Best three-point shooters."""
    df = _season(players, season, min_games).where(F.col("three_point_pct").isNotNull())
    df = top_k(df, "three_point_pct", k, tiebreak=TIEBREAK)
    return df.selectExpr(
        "player_name", "team_abbreviation",
        "round(three_point_pct * 100, 1) AS three_pct",
        "round(points_per_game, 1) AS ppg",
        "games_played",
    )
