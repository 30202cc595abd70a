"""Standings, conference summary, best offenses/defenses, playoff seeding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.ranking import seed_within
from courtside.operators.topk import top_k

TIEBREAK = ("team_name", "team_id")
# city || ' ' || name: NULL in, NULL out (concat, never concat_ws)
TEAM = "concat(team_city, ' ', team_name)"


def _season(teams: DataFrame, season: str) -> DataFrame:
    return teams.where(F.col("season") == season)


def t_all(teams: DataFrame, season: str) -> DataFrame:
    """Full standings, best record first."""
    df = top_k(_season(teams, season), "win_pct", None, tiebreak=TIEBREAK)
    return df.selectExpr(
        f"{TEAM} AS team",
        "team_abbreviation", "conference", "division",
        "wins", "losses", "total_games",
        "round(win_pct * 100, 1) AS win_pct",
        "win_pct_label", "home_record", "away_record", "last_10_record",
        "round(points_per_game, 1) AS off_ppg",
        "round(opp_points_per_game, 1) AS def_ppg",
        "round(net_rating, 1) AS net_rating",
        "season",
    )


def t_conf(teams: DataFrame, season: str) -> DataFrame:
    """Per conference: teams, total wins, unweighted averages over teams."""
    df = _season(teams, season).groupBy("conference").agg(*[F.expr(e) for e in (
        "CAST(count(1) AS BIGINT) AS teams",
        "CAST(sum(wins) AS BIGINT) AS total_wins",
        "round(avg(win_pct) * 100, 1) AS avg_win_pct",
        "round(avg(points_per_game), 1) AS avg_off_ppg",
        "round(avg(opp_points_per_game), 1) AS avg_def_ppg",
        "round(avg(net_rating), 1) AS avg_net_rating",
    )])
    return df.orderBy(F.col("avg_win_pct").desc_nulls_last(),
                      F.col("conference").asc_nulls_last())


def t_off(teams: DataFrame, season: str, k: int = 10) -> DataFrame:
    """Best offenses: highest points per game."""
    df = top_k(_season(teams, season), "points_per_game", k, tiebreak=TIEBREAK)
    return df.selectExpr(
        f"{TEAM} AS team", "conference",
        "round(points_per_game, 1) AS ppg",
        "round(net_rating, 1) AS net_rating",
        "wins", "losses",
    )


def t_def(teams: DataFrame, season: str, k: int = 10) -> DataFrame:
    """Best defenses: lowest opponent points per game (NULL never ranks)."""
    df = top_k(_season(teams, season), "opp_points_per_game", k, descending=False,
               tiebreak=TIEBREAK)
    return df.selectExpr(
        f"{TEAM} AS team", "conference",
        "round(opp_points_per_game, 1) AS opp_ppg",
        "round(net_rating, 1) AS net_rating",
        "wins", "losses",
    )


def t_seed(teams: DataFrame, season: str, k: int = 10) -> DataFrame:
    """Playoff picture: seeds 1..k per conference by win percentage."""
    df = seed_within(_season(teams, season), "conference", "win_pct",
                     tiebreak=TIEBREAK, k=k, name="conference_seed")
    return df.selectExpr(
        "conference", f"{TEAM} AS team", "wins", "losses",
        "round(win_pct * 100, 1) AS win_pct", "conference_seed",
    ).orderBy(F.col("conference").asc_nulls_last(), "conference_seed")
