"""Dashboard queries (``d_*``), its cards (``k_*``) and display tables (``r_*``).

``d_*`` read a processed table; ``k_*`` and ``r_*`` take a ``d_*`` frame.
Card rows are one aggregate each (several ``min_by`` / filtered terms in
one pass), never one job per card; ties go to the first row in display
order through a sortable display key, so no row numbering is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.coerce import without_nan
from courtside.functions.rates import pct_rate
from courtside.functions.text import percent_text, record_text, signed_text, thousands_text
from courtside.operators.aggregate import conditional_rate, rate_by_group
from courtside.operators.extremes import arg_extreme, display_key, first_in_order
from courtside.operators.ranking import seed_within
from courtside.operators.topk import top_k
from courtside.plans.shots import clutch_condition
from courtside.schemas import THREE_POINT_SHOT_TYPE

PLAYER_TIEBREAK = ("player_name", "player_id")
TEAM_TIEBREAK = ("team", "team_id")


# -- d_*: dashboard queries over processed tables ----------------------------

def d_players(players: DataFrame, season: str, min_games: int = 20, k: int = 50) -> DataFrame:
    """Top-k scorers with unrounded values, for the player page."""
    df = players.where((F.col("season") == season) & (F.col("games_played") >= min_games))
    df = top_k(df, "points_per_game", k, tiebreak=PLAYER_TIEBREAK)
    return df.selectExpr(
        "player_name", "team_abbreviation", "games_played",
        "points_per_game AS ppg", "assists_per_game AS apg", "rebounds_per_game AS rpg",
        "field_goal_pct AS fg_pct", "three_point_pct AS three_pct",
        "efficiency_rating AS efficiency", "true_shooting_pct AS ts_pct",
    )


def d_standings(teams: DataFrame, season: str, ordered: bool = True) -> DataFrame:
    """Standings for the team page, best record first. Cards and display
    tables take ``ordered=False``: they number rows themselves, so a
    global sort here would only add a range shuffle."""
    df = teams.where(F.col("season") == season).selectExpr(
        "concat(team_city, ' ', team_name) AS team", "team_id",
        "team_abbreviation", "conference", "division", "wins", "losses", "win_pct",
        "win_pct_label", "points_per_game AS ppg", "opp_points_per_game AS opp_ppg",
        "net_rating", "home_record", "away_record", "last_10_record",
    )
    if ordered:
        df = top_k(df, "win_pct", None, tiebreak=TEAM_TIEBREAK)
    return df.drop("team_id")


def d_shooters(shots: DataFrame, season: str) -> DataFrame:
    """Players that have shots in the season, by name."""
    return (shots.where(F.col("season") == season).select("player_name").distinct()
            .orderBy(F.col("player_name").asc_nulls_last()))


def d_shots(shots: DataFrame, season: str, player_name: str) -> DataFrame:
    """Every attempt of one player; the name is a bound value, never spliced."""
    return shots.where((F.col("season") == season)
                       & (F.col("player_name") == F.lit(player_name))).select(
        "shot_zone_label", "shot_zone_basic", "shot_zone_area", "loc_x", "loc_y",
        "shot_distance", "shot_made_flag", "made_label", "action_type", "shot_type",
        "period", "minutes_remaining",
    )


# -- k_*: cards ----------------------------------------------------------------

def k_players(d: DataFrame) -> DataFrame:
    """Scoring leader, top efficiency, best FG%, best 3PT% over the ``d_players`` rows."""
    d = without_nan(d)
    key = display_key("ppg", tiebreak=["player_name"])
    return d.agg(
        first_in_order("player_name", key).alias("scoring_leader"),
        first_in_order("ppg", key).alias("scoring_leader_ppg"),
        arg_extreme("player_name", "efficiency", key).alias("top_efficiency_player"),
        F.round(F.max("efficiency"), 1).alias("top_efficiency"),
        arg_extreme("player_name", "fg_pct", key).alias("best_fg_player"),
        F.round(F.max("fg_pct") * 100, 1).alias("best_fg_pct"),
        arg_extreme("player_name", "three_pct", key).alias("best_three_player"),
        F.round(F.max("three_pct") * 100, 1).alias("best_three_pct"),
    )


def k_teams(d: DataFrame) -> DataFrame:
    """Best record, best net rating, top offense, top defense over ``d_standings``."""
    d = without_nan(d)
    key = display_key("win_pct", tiebreak=["team"])
    return d.agg(
        first_in_order("team", key).alias("best_record_team"),
        first_in_order(record_text("wins", "losses"), key).alias("best_record"),
        arg_extreme("team", "net_rating", key).alias("best_net_team"),
        F.round(F.max("net_rating"), 1).alias("best_net_rating"),
        signed_text(F.max("net_rating")).alias("best_net_text"),
        arg_extreme("team", "ppg", key).alias("top_offense_team"),
        F.round(F.max("ppg"), 1).alias("top_offense_ppg"),
        arg_extreme("team", "opp_ppg", key, largest=False).alias("top_defense_team"),
        F.round(F.min("opp_ppg"), 1).alias("top_defense_opp_ppg"),
    )


def k_shots(d: DataFrame) -> DataFrame:
    """Attempts, FG% (over all rows), 3PT attempts and 3PT% (over non-NULL flags).

    No rows gives 0 attempts and 0 rates; threes whose flags are all NULL
    give a NULL 3PT%.
    """
    flag = F.col("shot_made_flag")
    is3 = F.col("shot_type") == THREE_POINT_SHOT_TYPE
    n = F.count(F.lit(1))
    n3 = F.count_if(is3)
    return d.agg(
        n.cast("bigint").alias("total_attempts"),
        thousands_text(n).alias("total_attempts_text"),
        F.when(n == 0, F.lit(0.0))
        .otherwise(pct_rate(F.coalesce(F.sum(flag), F.lit(0)), n)).alias("fg_pct"),
        n3.cast("bigint").alias("three_attempts"),
        F.when(n3 == 0, F.lit(0.0))
        .otherwise(conditional_rate("shot_made_flag", is3)).alias("three_pct"),
    )


def k_zones(d: DataFrame) -> DataFrame:
    """FG% by distance bucket for one player; NULL zones are dropped and only
    non-NULL flags are attempts, as a mean counts them."""
    df = rate_by_group(d, ["shot_zone_label"], "shot_made_flag", denominator="non_null",
                       drop_null_keys=True)
    df = df.withColumn("makes", F.coalesce(F.col("makes"), F.lit(0).cast("bigint")))
    return df.orderBy(F.col("fg_pct").asc_nulls_last(), F.col("shot_zone_label").asc_nulls_last())


def k_clutch(d: DataFrame) -> DataFrame:
    """Clutch attempts and FG% for one player; no clutch shot gives a NULL rate."""
    c = clutch_condition()
    return d.agg(
        F.count_if(c).cast("bigint").alias("clutch_attempts"),
        conditional_rate("shot_made_flag", c).alias("clutch_fg_pct"),
    )


# -- r_*: display tables -----------------------------------------------------------

def r_top15(d: DataFrame, k: int = 15) -> DataFrame:
    """Bar chart rows: the first k scorers of ``d_players``."""
    return top_k(d, "ppg", k, tiebreak=["player_name"]).select("player_name", "ppg")


def r_scatter(d: DataFrame) -> DataFrame:
    """Scoring-vs-efficiency points."""
    return d.select("ppg", "efficiency", "games_played", "apg", "rpg", "player_name")


def r_conf(d: DataFrame, conference: str) -> DataFrame:
    """One conference's table: 1-based position and percent text."""
    # one row a team: a conference's table is numbered as it is, without ranges
    df = seed_within(d.where(F.col("conference") == F.lit(conference)), "conference", "win_pct",
                     tiebreak=["team"], name="position")
    return df.select(
        "position", "team", "wins", "losses",
        percent_text("win_pct").alias("win_pct_text"),
        *[F.expr(e) for e in ("win_pct_label AS tier", "ppg AS off_ppg", "opp_ppg AS def_ppg",
                              "net_rating AS net_rtg", "home_record AS home",
                              "away_record AS away", "last_10_record AS l10")],
    ).orderBy("position")


def r_player_table(d: DataFrame) -> DataFrame:
    """Player display table with percent strings."""
    return d.select(
        *[F.expr(e) for e in ("player_name AS player", "team_abbreviation AS team",
                              "games_played AS gp", "ppg", "apg", "rpg")],
        percent_text("fg_pct").alias("fg_pct"),
        percent_text("three_pct").alias("three_pct"),
        F.expr("efficiency AS eff"),
        percent_text("ts_pct").alias("ts_pct"),
    )


def r_shot_points(d: DataFrame) -> DataFrame:
    """Shot-chart points colored by result, with the clutch subset flagged."""
    return d.select("loc_x", "loc_y", "made_label",
                    F.coalesce(clutch_condition(), F.lit(False)).alias("is_clutch"))
