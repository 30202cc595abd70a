"""Named queries over the stand-in tables: ``name -> f(spark, sf_dir)``.

Each callable builds its processed table from the whole driver tables
(``courtside.sources.standins``) and runs the named query on it with the
parameters below. The same query functions run unchanged on real
processed tables (``courtside.sources.processed.read_processed``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.snapshot import latest_snapshot
from courtside.plans import dashboard as D
from courtside.plans import landed as L
from courtside.plans import players as P
from courtside.plans import shots as S
from courtside.plans import teams as T
from courtside.sources import standins

# Parameters for the stand-in data (seasons that exist there; thresholds
# that leave non-empty answers at every scale).
PLAYER_SEASON = "1997-98"
TEAM_SEASON = "1998"
SHOT_SEASON = "2024-25"
SHOT_PLAYER = "Player 7"
TRIPLE = dict(min_points=26, min_assists=4, min_rebounds=4.5)
HOT_MIN_ATTEMPTS = 5
CONFERENCE = "East"


def _players(spark, sf):
    return standins.player_stats(spark, sf, PLAYER_SEASON)


def _teams(spark, sf):
    return standins.team_standings(spark, sf, TEAM_SEASON)


def _shots(spark, sf):
    return standins.shot_charts(spark, sf)


def _d_players(spark, sf):
    return D.d_players(_players(spark, sf), PLAYER_SEASON)


def _d_standings(spark, sf, ordered=True):
    return D.d_standings(_teams(spark, sf), TEAM_SEASON, ordered=ordered)


def _d_shots(spark, sf):
    return D.d_shots(_shots(spark, sf), SHOT_SEASON, SHOT_PLAYER)


def n_derive_teams(spark: SparkSession, sf: str) -> DataFrame:
    """Derived standings columns (total games, tier, net rating) for a season."""
    t = _teams(spark, sf).where(F.col("season") == TEAM_SEASON)
    return t.select("team_id", "team_name", "total_games", "win_pct_label", "net_rating",
                    "point_differential")


def n_derive_shots(spark: SparkSession, sf: str) -> DataFrame:
    """Derived shot labels, counted per label pair over the whole table."""
    return (_shots(spark, sf).groupBy("season", "shot_zone_label", "made_label")
            .agg(F.count(F.lit(1)).cast("bigint").alias("attempts")))


def n_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest daily snapshot per user over events-by-day, with its size."""
    snaps = latest_snapshot(standins.event_snapshots(spark, sf), ["user_id"], "date")
    return (snaps.groupBy("user_id", "date")
            .agg(F.count(F.lit(1)).cast("bigint").alias("events"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # player templates
    "p_top20": lambda s, sf: P.p_top20(_players(s, sf), PLAYER_SEASON),
    "p_triple": lambda s, sf: P.p_triple(_players(s, sf), PLAYER_SEASON, **TRIPLE),
    "p_eff": lambda s, sf: P.p_eff(_players(s, sf), PLAYER_SEASON),
    "p_three": lambda s, sf: P.p_three(_players(s, sf), PLAYER_SEASON),
    # team templates
    "t_all": lambda s, sf: T.t_all(_teams(s, sf), TEAM_SEASON),
    "t_conf": lambda s, sf: T.t_conf(_teams(s, sf), TEAM_SEASON),
    "t_off": lambda s, sf: T.t_off(_teams(s, sf), TEAM_SEASON),
    "t_def": lambda s, sf: T.t_def(_teams(s, sf), TEAM_SEASON),
    "t_seed": lambda s, sf: T.t_seed(_teams(s, sf), TEAM_SEASON),
    # shot templates
    "s_zone": lambda s, sf: S.s_zone(_shots(s, sf), SHOT_SEASON),
    "s_hot": lambda s, sf: S.s_hot(_shots(s, sf), SHOT_SEASON, min_attempts=HOT_MIN_ATTEMPTS),
    "s_share": lambda s, sf: S.s_share(_shots(s, sf), SHOT_SEASON),
    "s_clutch": lambda s, sf: S.s_clutch(_shots(s, sf), SHOT_SEASON),
    # dashboard queries
    "d_players": _d_players,
    "d_standings": _d_standings,
    "d_shooters": lambda s, sf: D.d_shooters(_shots(s, sf), SHOT_SEASON),
    "d_shots": _d_shots,
    # cards
    "k_players": lambda s, sf: D.k_players(_d_players(s, sf)),
    "k_teams": lambda s, sf: D.k_teams(_d_standings(s, sf, ordered=False)),
    "k_shots": lambda s, sf: D.k_shots(_d_shots(s, sf)),
    "k_zones": lambda s, sf: D.k_zones(_d_shots(s, sf)),
    "k_clutch": lambda s, sf: D.k_clutch(_d_shots(s, sf)),
    # display tables
    "r_top15": lambda s, sf: D.r_top15(_d_players(s, sf)),
    "r_scatter": lambda s, sf: D.r_scatter(_d_players(s, sf)),
    "r_conf": lambda s, sf: D.r_conf(_d_standings(s, sf, ordered=False), CONFERENCE),
    "r_player_table": lambda s, sf: D.r_player_table(_d_players(s, sf)),
    "r_shot_points": lambda s, sf: D.r_shot_points(_d_shots(s, sf)),
    # normalize / derive steps on the stand-ins
    "n_derive_teams": n_derive_teams,
    "n_derive_shots": n_derive_shots,
    "n_latest": n_latest,
    # landing round trips: CSV with drifting headers -> processed tables
    "l_teams": lambda s, sf: L.l_teams(s, sf, TEAM_SEASON),
    "l_shots": lambda s, sf: L.l_shots(s, sf, SHOT_SEASON),
    "l_players": lambda s, sf: L.l_players(s, sf, PLAYER_SEASON),
    "l_players_bare": lambda s, sf: L.l_players(s, sf, PLAYER_SEASON, attempts=False),
    "l_lossless": lambda s, sf: L.l_lossless(s, sf, SHOT_SEASON),
    "l_multiline": lambda s, sf: L.l_multiline(s, sf, SHOT_SEASON),
    # processed tables, catalog, manifest, results, stream, tracked list
    "w_processed": lambda s, sf: L.w_processed(s, sf, TEAM_SEASON),
    "c_added_column": lambda s, sf: L.c_added_column(s, sf, TEAM_SEASON),
    "m_land_all": lambda s, sf: L.m_land_all(s, sf, SHOT_SEASON),
    "w_result": lambda s, sf: L.w_result(s, sf, PLAYER_SEASON),
    "st_land": lambda s, sf: L.st_land(s, sf, SHOT_SEASON),
    "st_corrected": lambda s, sf: L.st_corrected(s, sf, SHOT_SEASON),
    "st_manifest": lambda s, sf: L.st_manifest(s, sf, SHOT_SEASON),
    "w_compact": lambda s, sf: L.w_compact(s, sf, SHOT_SEASON),
    "h_columns": L.h_columns,
    "w_daily": lambda s, sf: L.w_daily(s, sf, SHOT_SEASON),
    # one player's shots from a table clustered by player
    "c_d_shots": lambda s, sf: D.d_shots(L.clustered_shots(s, sf), SHOT_SEASON, SHOT_PLAYER),
    "c_k_zones": lambda s, sf: D.k_zones(D.d_shots(L.clustered_shots(s, sf), SHOT_SEASON, SHOT_PLAYER)),
    "x_tracked": lambda s, sf: L.x_tracked(s, sf, SHOT_SEASON),
    # the named queries through the catalog
    "q_p_top20": L.by_name("p_top20", season=PLAYER_SEASON),
    "q_p_triple": L.by_name("p_triple", season=PLAYER_SEASON, **TRIPLE),
    "q_t_all": L.by_name("t_all", season=TEAM_SEASON),
    "q_t_seed": L.by_name("t_seed", season=TEAM_SEASON),
    "q_s_hot": L.by_name("s_hot", season=SHOT_SEASON, min_attempts=HOT_MIN_ATTEMPTS),
    "q_d_shooters": L.by_name("d_shooters", season=SHOT_SEASON),
    "q_d_shots": L.by_name("d_shots", season=SHOT_SEASON, player_name=SHOT_PLAYER),
}
