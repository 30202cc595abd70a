"""Independent SQL (DuckDB dialect) for every registered query.

Written by hand from the query semantics, not generated from the Spark
plans, so the driver's side-by-side run is a real cross-check. The
driver pre-registers the raw tables as views; each text carries the
stand-in tables it needs as CTEs. Conventions shared with the Spark
side: integer sums and ROW_NUMBER are BIGINT, rounded rates DOUBLE,
every ORDER BY feeding a LIMIT or a window spells NULLS LAST and a name
tiebreak, and QUALIFY is written as a subquery filter.
"""

from __future__ import annotations

from courtside.plans.registry import (
    CONFERENCE, HOT_MIN_ATTEMPTS, PLAYER_SEASON, SHOT_PLAYER, SHOT_SEASON, TEAM_SEASON, TRIPLE,
)
from courtside.schemas import SHOT_COLUMNS

PLAYER_STATS_CTE = """
player_stats AS (
  SELECT CAST(t.player_id AS BIGINT) AS player_id,
         s.s_name AS player_name,
         n.n_name AS team_abbreviation,
         t.gp AS games_played,
         t.fga / t.gp * 10 AS minutes_per_game,
         t.pts / t.gp AS points_per_game,
         t.ast / t.gp AS assists_per_game,
         t.reb / t.gp AS rebounds_per_game,
         t.stl / t.gp AS steals_per_game,
         t.blk / t.gp AS blocks_per_game,
         t.fgm / NULLIF(t.fga, 0) AS field_goal_pct,
         t.tpm / NULLIF(t.tpa, 0) AS three_point_pct,
         t.ftm / NULLIF(t.fta, 0) AS free_throw_pct,
         (t.pts + t.ast + t.reb + t.stl + t.blk - (t.fga - t.fgm) - (t.fta - t.ftm)) / t.gp
           AS efficiency_rating,
         t.pts / (2 * (t.fga + 0.44E0 * t.fta)) AS true_shooting_pct,
         CAST(t.y AS VARCHAR) || '-' || lpad(CAST((t.y + 1) % 100 AS VARCHAR), 2, '0') AS season
  FROM (
    SELECT l_suppkey AS player_id, year(l_shipdate) AS y,
           CAST(COUNT(DISTINCT l_orderkey) AS INTEGER) AS gp,
           SUM(l_quantity) AS pts,
           SUM(l_linenumber) AS ast,
           SUM(CASE WHEN l_linestatus = 'O' THEN 6 ELSE 3 END) AS reb,
           SUM(ROUND(l_tax * 100)) AS stl,
           SUM(ROUND(l_discount * 100)) AS blk,
           COUNT(*) FILTER (WHERE l_returnflag = 'N') AS fgm,
           COUNT(*) AS fga,
           COUNT(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') AS ftm,
           COUNT(*) FILTER (WHERE l_linestatus = 'F') AS fta,
           COUNT(*) FILTER (WHERE l_quantity >= 40 AND l_returnflag = 'A') AS tpm,
           COUNT(*) FILTER (WHERE l_quantity >= 40) AS tpa
    FROM lineitem
    GROUP BY l_suppkey, year(l_shipdate)
  ) t
  JOIN supplier s ON t.player_id = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

TEAM_STANDINGS_CTE = """
team_standings AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS team_id,
         r.r_name AS team_city,
         n.n_name AS team_name,
         n.n_name AS team_abbreviation,
         CASE WHEN n.n_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS conference,
         r.r_name AS division,
         CAST(a.w AS INTEGER) AS wins,
         CAST(a.l AS INTEGER) AS losses,
         CAST(a.w + a.l AS INTEGER) AS total_games,
         a.w / NULLIF(a.w + a.l, 0) AS win_pct,
         CASE WHEN a.w / NULLIF(a.w + a.l, 0) >= 0.6 THEN 'Elite'
              WHEN a.w / NULLIF(a.w + a.l, 0) >= 0.5 THEN 'Winning'
              WHEN a.w / NULLIF(a.w + a.l, 0) >= 0.4 THEN 'Bubble'
              WHEN a.w / NULLIF(a.w + a.l, 0) IS NOT NULL THEN 'Rebuilding' END AS win_pct_label,
         CAST(a.hw AS VARCHAR) || '-' || CAST(a.hl AS VARCHAR) AS home_record,
         CAST(a.aw AS VARCHAR) || '-' || CAST(a.al AS VARCHAR) AS away_record,
         CAST(NULL AS VARCHAR) AS last_10_record,
         CAST(a.pf AS DOUBLE) / 1000 / NULLIF(a.w, 0) AS points_per_game,
         CAST(a.pa AS DOUBLE) / 1000 / NULLIF(a.l, 0) AS opp_points_per_game,
         CAST(a.pf AS DOUBLE) / 1000 / NULLIF(a.w, 0)
           - CAST(a.pa AS DOUBLE) / 1000 / NULLIF(a.l, 0) AS point_differential,
         CAST(a.pf AS DOUBLE) / 1000 / NULLIF(a.w, 0)
           - CAST(a.pa AS DOUBLE) / 1000 / NULLIF(a.l, 0) AS net_rating,
         CAST(a.y AS VARCHAR) AS season
  FROM (
    SELECT c.c_nationkey AS nk, year(o.o_orderdate) AS y,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'F') AS w,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'O') AS l,
           SUM(CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS pf,
           SUM(CASE WHEN o.o_orderstatus = 'O' THEN CAST(o.o_totalprice AS DECIMAL(14,2)) END) AS pa,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'F' AND o.o_orderpriority < '3') AS hw,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'O' AND o.o_orderpriority < '3') AS hl,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'F' AND o.o_orderpriority >= '3') AS aw,
           COUNT(*) FILTER (WHERE o.o_orderstatus = 'O' AND o.o_orderpriority >= '3') AS al
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    GROUP BY c.c_nationkey, year(o.o_orderdate)
  ) a
  JOIN nation n ON a.nk = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SHOT_CHARTS_CTE = """
shot_charts AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS game_id,
         CAST(user_id AS BIGINT) AS player_id,
         'Player ' || CAST(user_id AS VARCHAR) AS player_name,
         CAST(NULL AS BIGINT) AS team_id,
         CAST(NULL AS VARCHAR) AS team_name,
         CAST(gm // 12 + 1 AS INTEGER) AS period,
         CAST(11 - gm % 12 AS INTEGER) AS minutes_remaining,
         0 AS seconds_remaining,
         event_type,
         event_type AS action_type,
         CASE WHEN dist >= 23 THEN '3PT Field Goal' ELSE '2PT Field Goal' END AS shot_type,
         CASE WHEN dist < 8 THEN 'Restricted Area' WHEN dist < 23 THEN 'Mid-Range'
              ELSE 'Above the Break 3' END AS shot_zone_basic,
         CASE WHEN event_id % 500 - 250 < -83 THEN 'Left'
              WHEN event_id % 500 - 250 < 83 THEN 'Center' ELSE 'Right' END AS shot_zone_area,
         CAST(dist AS INTEGER) AS shot_distance,
         CAST(event_id % 500 - 250 AS INTEGER) AS loc_x,
         CAST(event_id % 470 - 47 AS INTEGER) AS loc_y,
         flag AS shot_made_flag,
         CASE WHEN dist < 8 THEN 'Close' WHEN dist < 16 THEN 'Mid' WHEN dist < 23 THEN 'Long two'
              WHEN dist IS NOT NULL THEN 'Three' END AS shot_zone_label,
         CASE WHEN flag = 1 THEN 'Made' WHEN flag = 0 THEN 'Missed' END AS made_label,
         CASE WHEN day(ts) <= 15 THEN '2023-24' ELSE '2024-25' END AS season
  FROM (
    SELECT *,
           (hour(ts) * 60 + minute(ts)) % 48 AS gm,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 40 AS dist,
           CASE WHEN event_type IN ('purchase', 'signup') THEN 1
                WHEN event_type = 'error' THEN NULL ELSE 0 END AS flag
    FROM events
  ) e
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_P, _T, _S = PLAYER_STATS_CTE, TEAM_STANDINGS_CTE, SHOT_CHARTS_CTE

D_PLAYERS_CTE = f"""
d AS (
  SELECT player_name, team_abbreviation, games_played,
         points_per_game AS ppg, assists_per_game AS apg, rebounds_per_game AS rpg,
         field_goal_pct AS fg_pct, three_point_pct AS three_pct,
         efficiency_rating AS efficiency, true_shooting_pct AS ts_pct
  FROM player_stats
  WHERE season = '{PLAYER_SEASON}' AND games_played >= 20
  ORDER BY points_per_game DESC NULLS LAST, player_name, player_id
  LIMIT 50
)"""

D_STANDINGS_CTE = f"""
d AS (
  SELECT team_city || ' ' || team_name AS team, team_abbreviation, conference, division,
         wins, losses, win_pct, win_pct_label,
         points_per_game AS ppg, opp_points_per_game AS opp_ppg, net_rating,
         home_record, away_record, last_10_record
  FROM team_standings
  WHERE season = '{TEAM_SEASON}'
)"""

D_SHOTS_CTE = f"""
d AS (
  SELECT shot_zone_label, shot_zone_basic, shot_zone_area, loc_x, loc_y, shot_distance,
         shot_made_flag, made_label, action_type, shot_type, period, minutes_remaining
  FROM shot_charts
  WHERE season = '{SHOT_SEASON}' AND player_name = '{SHOT_PLAYER}'
)"""

_RATE = "CAST(ROUND({num} * 100.0 / {den}, 1) AS DOUBLE)"
_CLUTCH = "period = 4 AND minutes_remaining <= 5"

ORACLE_SQL: dict[str, str] = {
    "p_top20": _with(_P) + f"""
SELECT player_name, team_abbreviation, games_played,
       ROUND(points_per_game, 1) AS ppg, ROUND(assists_per_game, 1) AS apg,
       ROUND(rebounds_per_game, 1) AS rpg, ROUND(steals_per_game, 1) AS spg,
       ROUND(blocks_per_game, 1) AS bpg,
       ROUND(field_goal_pct * 100, 1) AS fg_pct, ROUND(three_point_pct * 100, 1) AS three_pct,
       ROUND(free_throw_pct * 100, 1) AS ft_pct, ROUND(true_shooting_pct * 100, 1) AS ts_pct,
       ROUND(efficiency_rating, 1) AS efficiency, season
FROM player_stats
WHERE season = '{PLAYER_SEASON}' AND games_played >= 20
ORDER BY points_per_game DESC NULLS LAST, player_name, player_id
LIMIT 20""",

    "p_triple": _with(_P) + f"""
SELECT player_name, team_abbreviation,
       ROUND(points_per_game, 1) AS ppg, ROUND(assists_per_game, 1) AS apg,
       ROUND(rebounds_per_game, 1) AS rpg, ROUND(efficiency_rating, 1) AS efficiency
FROM player_stats
WHERE season = '{PLAYER_SEASON}'
  AND points_per_game >= {TRIPLE['min_points']}
  AND assists_per_game >= {TRIPLE['min_assists']}
  AND rebounds_per_game >= {TRIPLE['min_rebounds']}
ORDER BY points_per_game DESC NULLS LAST, player_name""",

    "p_eff": _with(_P) + f"""
SELECT player_name, team_abbreviation, games_played,
       ROUND(efficiency_rating, 1) AS efficiency, ROUND(true_shooting_pct * 100, 1) AS ts_pct,
       ROUND(points_per_game, 1) AS ppg
FROM player_stats
WHERE season = '{PLAYER_SEASON}' AND games_played >= 20
ORDER BY efficiency_rating DESC NULLS LAST, player_name, player_id
LIMIT 15""",

    "p_three": _with(_P) + f"""
SELECT player_name, team_abbreviation, ROUND(three_point_pct * 100, 1) AS three_pct,
       ROUND(points_per_game, 1) AS ppg, games_played
FROM player_stats
WHERE season = '{PLAYER_SEASON}' AND games_played >= 20 AND three_point_pct IS NOT NULL
ORDER BY three_point_pct DESC NULLS LAST, player_name, player_id
LIMIT 15""",

    "t_all": _with(_T) + f"""
SELECT team_city || ' ' || team_name AS team, team_abbreviation, conference, division,
       wins, losses, total_games, ROUND(win_pct * 100, 1) AS win_pct, win_pct_label,
       home_record, away_record, last_10_record,
       ROUND(points_per_game, 1) AS off_ppg, ROUND(opp_points_per_game, 1) AS def_ppg,
       ROUND(net_rating, 1) AS net_rating, season
FROM team_standings
WHERE season = '{TEAM_SEASON}'""",

    "t_conf": _with(_T) + f"""
SELECT conference, CAST(COUNT(*) AS BIGINT) AS teams, CAST(SUM(wins) AS BIGINT) AS total_wins,
       ROUND(AVG(win_pct) * 100, 1) AS avg_win_pct,
       ROUND(AVG(points_per_game), 1) AS avg_off_ppg,
       ROUND(AVG(opp_points_per_game), 1) AS avg_def_ppg,
       ROUND(AVG(net_rating), 1) AS avg_net_rating
FROM team_standings
WHERE season = '{TEAM_SEASON}'
GROUP BY conference""",

    "t_off": _with(_T) + f"""
SELECT team_city || ' ' || team_name AS team, conference,
       ROUND(points_per_game, 1) AS ppg, ROUND(net_rating, 1) AS net_rating, wins, losses
FROM team_standings
WHERE season = '{TEAM_SEASON}'
ORDER BY points_per_game DESC NULLS LAST, team_name, team_id
LIMIT 10""",

    "t_def": _with(_T) + f"""
SELECT team_city || ' ' || team_name AS team, conference,
       ROUND(opp_points_per_game, 1) AS opp_ppg, ROUND(net_rating, 1) AS net_rating, wins, losses
FROM team_standings
WHERE season = '{TEAM_SEASON}'
ORDER BY opp_points_per_game ASC NULLS LAST, team_name, team_id
LIMIT 10""",

    "t_seed": _with(_T) + f"""
SELECT conference, team, wins, losses, win_pct, conference_seed
FROM (
  SELECT conference, team_city || ' ' || team_name AS team, wins, losses,
         ROUND(win_pct * 100, 1) AS win_pct,
         CAST(ROW_NUMBER() OVER (PARTITION BY conference
                                 ORDER BY team_standings.win_pct DESC NULLS LAST,
                                          team_name, team_id) AS BIGINT) AS conference_seed
  FROM team_standings
  WHERE season = '{TEAM_SEASON}'
) s
WHERE conference_seed <= 10""",

    "s_zone": _with(_S) + f"""
SELECT player_name, shot_zone_label, CAST(COUNT(*) AS BIGINT) AS attempts,
       CAST(SUM(shot_made_flag) AS BIGINT) AS makes,
       {_RATE.format(num="SUM(shot_made_flag)", den="COUNT(*)")} AS fg_pct, season
FROM shot_charts
WHERE season = '{SHOT_SEASON}'
GROUP BY player_name, shot_zone_label, season""",

    "s_hot": _with(_S) + f"""
SELECT player_name, shot_zone_basic, shot_zone_area, CAST(COUNT(*) AS BIGINT) AS attempts,
       {_RATE.format(num="SUM(shot_made_flag)", den="COUNT(*)")} AS fg_pct
FROM shot_charts
WHERE season = '{SHOT_SEASON}' AND shot_made_flag IS NOT NULL
GROUP BY player_name, shot_zone_basic, shot_zone_area
HAVING COUNT(*) >= {HOT_MIN_ATTEMPTS}""",

    "s_share": _with(_S) + f"""
SELECT player_name, shot_zone_label, CAST(COUNT(*) AS BIGINT) AS total_attempts,
       CAST(SUM(shot_made_flag) AS BIGINT) AS total_makes,
       {_RATE.format(num="SUM(shot_made_flag)", den="COUNT(*)")} AS fg_pct,
       {_RATE.format(num="COUNT(*)", den="SUM(COUNT(*)) OVER (PARTITION BY player_name)")}
         AS pct_of_shots
FROM shot_charts
WHERE season = '{SHOT_SEASON}'
GROUP BY player_name, shot_zone_label""",

    "s_clutch": _with(_S) + f"""
SELECT player_name, CAST(COUNT(*) AS BIGINT) AS clutch_attempts,
       CAST(SUM(shot_made_flag) AS BIGINT) AS clutch_makes,
       {_RATE.format(num="SUM(shot_made_flag)", den="COUNT(*)")} AS clutch_fg_pct
FROM shot_charts
WHERE season = '{SHOT_SEASON}' AND {_CLUTCH}
GROUP BY player_name
HAVING COUNT(*) >= 5""",

    "d_players": _with(_P, D_PLAYERS_CTE) + "SELECT * FROM d",

    "d_standings": _with(_T, D_STANDINGS_CTE) + "SELECT * FROM d",

    "d_shooters": _with(_S) + f"""
SELECT DISTINCT player_name FROM shot_charts WHERE season = '{SHOT_SEASON}'""",

    "d_shots": _with(_S, D_SHOTS_CTE) + "SELECT * FROM d",

    "k_players": _with(_P, D_PLAYERS_CTE) + """,
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ppg DESC NULLS LAST, player_name) AS ord FROM d)
SELECT arg_min(player_name, ord) AS scoring_leader,
       arg_min(ppg, ord) AS scoring_leader_ppg,
       first(player_name ORDER BY efficiency DESC, ord)
         FILTER (WHERE efficiency IS NOT NULL AND NOT isnan(efficiency)) AS top_efficiency_player,
       ROUND(MAX(efficiency), 1) AS top_efficiency,
       first(player_name ORDER BY fg_pct DESC, ord)
         FILTER (WHERE fg_pct IS NOT NULL AND NOT isnan(fg_pct)) AS best_fg_player,
       ROUND(MAX(fg_pct) * 100, 1) AS best_fg_pct,
       first(player_name ORDER BY three_pct DESC, ord)
         FILTER (WHERE three_pct IS NOT NULL AND NOT isnan(three_pct)) AS best_three_player,
       ROUND(MAX(three_pct) * 100, 1) AS best_three_pct
FROM o""",

    "k_teams": _with(_T, D_STANDINGS_CTE) + """,
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY win_pct DESC NULLS LAST, team) AS ord FROM d)
SELECT arg_min(team, ord) AS best_record_team,
       arg_min(CAST(wins AS VARCHAR) || '-' || CAST(losses AS VARCHAR), ord) AS best_record,
       first(team ORDER BY net_rating DESC, ord)
         FILTER (WHERE net_rating IS NOT NULL AND NOT isnan(net_rating)) AS best_net_team,
       ROUND(MAX(net_rating), 1) AS best_net_rating,
       printf('%+.1f', ROUND(MAX(net_rating), 1)) AS best_net_text,
       first(team ORDER BY ppg DESC, ord)
         FILTER (WHERE ppg IS NOT NULL AND NOT isnan(ppg)) AS top_offense_team,
       ROUND(MAX(ppg), 1) AS top_offense_ppg,
       first(team ORDER BY opp_ppg ASC, ord)
         FILTER (WHERE opp_ppg IS NOT NULL AND NOT isnan(opp_ppg)) AS top_defense_team,
       ROUND(MIN(opp_ppg), 1) AS top_defense_opp_ppg
FROM o""",

    "k_shots": _with(_S, D_SHOTS_CTE) + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_attempts, format('{{:,}}', COUNT(*)) AS total_attempts_text,
       CASE WHEN COUNT(*) = 0 THEN 0.0
            ELSE {_RATE.format(num="COALESCE(SUM(shot_made_flag), 0)", den="COUNT(*)")} END
         AS fg_pct,
       CAST(COUNT(*) FILTER (WHERE shot_type = '3PT Field Goal') AS BIGINT) AS three_attempts,
       CASE WHEN COUNT(*) FILTER (WHERE shot_type = '3PT Field Goal') = 0 THEN 0.0
            ELSE {_RATE.format(
                num="SUM(shot_made_flag) FILTER (WHERE shot_type = '3PT Field Goal')",
                den="NULLIF(COUNT(shot_made_flag) FILTER (WHERE shot_type = '3PT Field Goal'), 0)")}
       END AS three_pct
FROM d""",

    "k_zones": _with(_S, D_SHOTS_CTE) + f"""
SELECT shot_zone_label, CAST(COUNT(shot_made_flag) AS BIGINT) AS attempts,
       CAST(COALESCE(SUM(shot_made_flag), 0) AS BIGINT) AS makes,
       {_RATE.format(num="SUM(shot_made_flag)", den="NULLIF(COUNT(shot_made_flag), 0)")} AS fg_pct
FROM d
WHERE shot_zone_label IS NOT NULL
GROUP BY shot_zone_label""",

    "k_clutch": _with(_S, D_SHOTS_CTE) + f"""
SELECT CAST(COUNT(*) FILTER (WHERE {_CLUTCH}) AS BIGINT) AS clutch_attempts,
       {_RATE.format(num=f"SUM(shot_made_flag) FILTER (WHERE {_CLUTCH})",
                     den=f"NULLIF(COUNT(shot_made_flag) FILTER (WHERE {_CLUTCH}), 0)")}
         AS clutch_fg_pct
FROM d""",

    "r_top15": _with(_P, D_PLAYERS_CTE) + """
SELECT player_name, ppg FROM d ORDER BY ppg DESC NULLS LAST, player_name LIMIT 15""",

    "r_scatter": _with(_P, D_PLAYERS_CTE) + """
SELECT ppg, efficiency, games_played, apg, rpg, player_name FROM d""",

    "r_conf": _with(_T, D_STANDINGS_CTE) + f"""
SELECT CAST(ROW_NUMBER() OVER (PARTITION BY conference
                               ORDER BY win_pct DESC NULLS LAST, team) AS BIGINT) AS position,
       team, wins, losses,
       CASE WHEN win_pct IS NOT NULL THEN printf('%.1f%%', ROUND(win_pct * 100, 1)) END
         AS win_pct_text,
       win_pct_label AS tier, ppg AS off_ppg, opp_ppg AS def_ppg, net_rating AS net_rtg,
       home_record AS home, away_record AS away, last_10_record AS l10
FROM d
WHERE conference = '{CONFERENCE}'""",

    "r_player_table": _with(_P, D_PLAYERS_CTE) + """
SELECT player_name AS player, team_abbreviation AS team, games_played AS gp, ppg, apg, rpg,
       CASE WHEN fg_pct IS NOT NULL THEN printf('%.1f%%', ROUND(fg_pct * 100, 1)) END AS fg_pct,
       CASE WHEN three_pct IS NOT NULL THEN printf('%.1f%%', ROUND(three_pct * 100, 1)) END
         AS three_pct,
       efficiency AS eff,
       CASE WHEN ts_pct IS NOT NULL THEN printf('%.1f%%', ROUND(ts_pct * 100, 1)) END AS ts_pct
FROM d""",

    "r_shot_points": _with(_S, D_SHOTS_CTE) + f"""
SELECT loc_x, loc_y, made_label, COALESCE({_CLUTCH}, FALSE) AS is_clutch FROM d""",

    "n_derive_teams": _with(_T) + f"""
SELECT team_id, team_name, total_games, win_pct_label, net_rating, point_differential
FROM team_standings WHERE season = '{TEAM_SEASON}'""",

    "n_derive_shots": _with(_S) + """
SELECT season, shot_zone_label, made_label, CAST(COUNT(*) AS BIGINT) AS attempts
FROM shot_charts GROUP BY season, shot_zone_label, made_label""",

    "l_teams": _with(_T) + f"""
SELECT * FROM team_standings WHERE season = '{TEAM_SEASON}'""",

    "l_shots": _with(_S) + f"""
SELECT * FROM shot_charts WHERE season = '{SHOT_SEASON}'""",

    "n_latest": """
WITH e AS (SELECT user_id, value, CAST(ts AS DATE) AS date FROM events)
SELECT user_id, date, CAST(COUNT(*) AS BIGINT) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM e
WHERE date = (SELECT MAX(e2.date) FROM e e2 WHERE e2.user_id = e.user_id)
GROUP BY user_id, date""",
}

_PLAYERS_BACK = """
SELECT player_id, 'Al "Ace", ' || player_name AS player_name, team_abbreviation, games_played,
       minutes_per_game, points_per_game, assists_per_game, rebounds_per_game, steals_per_game,
       blocks_per_game, field_goal_pct, three_point_pct, free_throw_pct, efficiency_rating,
       {ts} AS true_shooting_pct, season
FROM player_stats WHERE season = '{season}'"""

_SPELLINGS = ", ".join([f"(FALSE, '{c}', '{c if c == 'player_id' else c.upper()}', {i + 1})" for i, c in enumerate(SHOT_COLUMNS)]
                       + [f"(TRUE, '{c}', '{c}', {len(SHOT_COLUMNS) - i})" for i, c in enumerate(SHOT_COLUMNS)])

ORACLE_SQL |= {
    "l_players": _with(_P) + _PLAYERS_BACK.format(
        ts="points_per_game / NULLIF(2 * (points_per_game + 0.44E0 * 0.0E0), 0)", season=PLAYER_SEASON),
    "l_players_bare": _with(_P) + _PLAYERS_BACK.format(ts="CAST(NULL AS DOUBLE)", season=PLAYER_SEASON),
    "l_lossless": _with(_S) + f"""
SELECT player_id, player_name, made_label, COUNT(*) AS shots, CAST(SUM(shot_distance) AS BIGINT) AS feet
FROM (SELECT CASE WHEN loc_x % 3 = 0 THEN NULL WHEN loc_x % 3 = 1 THEN 9007199254740993 + player_id
                  ELSE player_id END AS player_id,
             player_name || ' "Jr", the' AS player_name, made_label, shot_distance
      FROM shot_charts WHERE season = '{SHOT_SEASON}')
GROUP BY ALL""",
    "w_processed": _with(_T) + f"""
SELECT * FROM team_standings WHERE season = '{TEAM_SEASON}'""",
    "c_added_column": _with(_T) + f"""
SELECT season, COUNT(*) AS teams, CAST(SUM(wins) AS BIGINT) AS wins,
       CAST(SUM(CASE WHEN season = '{TEAM_SEASON}' THEN losses END) AS BIGINT) AS losses
FROM team_standings GROUP BY season""",
    "m_land_all": _with(_T, _S.strip()) + f"""
, played AS (SELECT player_id, COUNT(*) AS n FROM shot_charts WHERE season = '{SHOT_SEASON}' GROUP BY player_id)
SELECT 'team_standings' AS dataset, CAST(NULL AS BIGINT) AS entity_id, 'success' AS status, COUNT(*) AS rows FROM team_standings
UNION ALL SELECT 'player_stats', NULL, 'empty', 0
UNION ALL
SELECT 'shot_charts', COALESCE(p.player_id, c.c_custkey), CASE WHEN p.n > 0 THEN 'success' ELSE 'empty' END, COALESCE(p.n, 0)
FROM played p FULL JOIN customer c ON c.c_custkey = p.player_id""",
    "l_multiline": _with(_S) + f"""
SELECT player_name || CASE WHEN loc_x % 3 = 0 THEN ' "Jr",' || chr(10) || 'the' || chr(10) || chr(10) || '"2nd"' ELSE '' END AS player_name,
       action_type || CASE WHEN loc_y % 2 = 0 THEN chr(10) || ', "x"' || chr(10) ELSE ', y' END AS action_type,
       made_label, COUNT(*) AS shots, CAST(SUM(shot_distance) AS BIGINT) AS feet, MIN(game_id) AS first_game
FROM shot_charts WHERE season = '{SHOT_SEASON}' GROUP BY ALL""",
    "st_corrected": _with(_S) + f"""
, s AS (SELECT *, player_id % 6 AS bucket FROM shot_charts WHERE season = '{SHOT_SEASON}')
SELECT date, load, CAST(bucket AS INTEGER) AS bucket, COUNT(*) AS shots, CAST(SUM(feet) AS BIGINT) AS feet FROM (
  SELECT DATE '2025-01-01' AS date, CASE WHEN player_id % 3 = 0 THEN 2 ELSE 0 END::BIGINT AS load, bucket,
         shot_distance + CASE WHEN player_id % 3 = 0 THEN 1 ELSE 0 END AS feet FROM s
  UNION ALL SELECT DATE '2025-01-02', 1::BIGINT, bucket, shot_distance FROM s WHERE player_id % 2 = 0)
GROUP BY ALL""",
    "st_manifest": _with(_S) + f"""
, s AS (SELECT * FROM shot_charts WHERE season = '{SHOT_SEASON}')
SELECT load, date, COUNT(DISTINCT player_id) AS deliveries, COUNT(*) AS rows FROM (
  SELECT 0::BIGINT AS load, DATE '2025-01-01' AS date, player_id FROM s
  UNION ALL SELECT 1, DATE '2025-01-02', player_id FROM s WHERE player_id % 2 = 0
  UNION ALL SELECT 2, DATE '2025-01-01', player_id FROM s WHERE player_id % 3 = 0)
GROUP BY ALL""",
    "w_compact": _with(_S) + f"""
, s AS (SELECT * FROM shot_charts WHERE season = '{SHOT_SEASON}')
SELECT date, load, made_label, COUNT(*) AS shots, CAST(SUM(feet) AS BIGINT) AS feet, CAST(SUM(loc_x) AS BIGINT) AS x FROM (
  SELECT DATE '2025-01-01' AS date, CASE WHEN player_id % 3 = 0 THEN 2 ELSE 0 END::BIGINT AS load, made_label, loc_x,
         shot_distance + CASE WHEN player_id % 3 = 0 THEN 1 ELSE 0 END AS feet FROM s
  UNION ALL SELECT DATE '2025-01-02', 1::BIGINT, made_label, loc_x, shot_distance FROM s WHERE player_id % 2 = 0)
GROUP BY ALL""",
    "h_columns": _with(_S) + f"""
, days AS (SELECT d, day(d) BETWEEN 11 AND 20 AS second, ROW_NUMBER() OVER (ORDER BY d) AS n
         FROM (SELECT DISTINCT CAST(game_id AS DATE) AS d FROM shot_charts)),
runs AS (SELECT d, second, n - ROW_NUMBER() OVER (PARTITION BY second ORDER BY d) AS run FROM days),
names(second, "column", spelling, position) AS (VALUES {_SPELLINGS})
SELECT 'shot_charts' AS dataset, "column", spelling, position, MIN(d) AS first_day, MAX(d) AS last_day, COUNT(*) AS days
FROM runs JOIN names USING (second) GROUP BY "column", spelling, position, run""",
    "w_daily": _with(_S, _T.strip()) + f"""
SELECT 'player' AS kind, player_id AS id, COUNT(*) AS rows, CAST(SUM(loc_x + CASE WHEN player_id % 5 = 0 THEN 1000 ELSE 0 END) AS BIGINT) AS total
FROM shot_charts WHERE season = '{SHOT_SEASON}' GROUP BY player_id
UNION ALL SELECT 'team', team_id, 1, CAST(wins AS BIGINT) FROM team_standings WHERE season = '{TEAM_SEASON}'""",
    "c_d_shots": ORACLE_SQL["d_shots"],
    "c_k_zones": ORACLE_SQL["k_zones"],
    "w_result": ORACLE_SQL["p_eff"],
    "st_land": _with(_S) + f"""
SELECT CAST(player_id % 2 AS INTEGER) AS load, shot_zone_label, made_label, COUNT(*) AS shots, COUNT(DISTINCT player_id) AS players
FROM shot_charts WHERE season = '{SHOT_SEASON}' GROUP BY ALL""",
    "x_tracked": _with(_S) + f"""
SELECT player_id, COUNT(*) AS shots FROM shot_charts
WHERE season = '{SHOT_SEASON}' AND player_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 6) GROUP BY player_id""",
    **{f"q_{n}": ORACLE_SQL[n] for n in ("p_top20", "p_triple", "t_all", "t_seed", "s_hot", "d_shooters", "d_shots")},
}
