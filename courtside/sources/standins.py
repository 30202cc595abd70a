"""Stand-in processed tables derived from the driver's TPC-H-like tables.

The three processed shapes (player_stats, team_standings, shot_charts)
are computed by Spark from whole ``lineitem`` / ``orders`` / ``events``
tables, so every query's work grows with the data.

Plan shape, chosen for scale:

* the fact side is aggregated *before* it meets a dimension
  (lineitem by supplier x year, orders by customer x year): the join
  then moves one row per entity and year instead of every fact row, and a
  hot supplier or customer collapses to one partial row per task;
* the distinct-order count runs apart from the sums, so the one exchange
  that sees every lineitem row carries three key columns;
* how dimensions are joined is left to the planner and AQE, which know
  their sizes;
* money is summed in whole cents (BIGINT), so totals are exact and
  independent of partitioning; counts and whole-number sums are exact by
  construction.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.labels import made_label_sql, tier_label_sql, zone_label_sql

# Declared input schemas (only the columns the stand-ins read): no schema
# inference job per read, and the scan's ReadSchema is exactly these.
INPUT_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    reader = spark.read
    if name in INPUT_SCHEMAS:
        reader = reader.schema(INPUT_SCHEMAS[name])
    df = reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def _year_range(column: str, first_year: int, last_year: int) -> str:
    """A range predicate the Parquet scan can push down (row-group pruning)."""
    return (f"{column} >= TIMESTAMP_NTZ'{first_year}-01-01 00:00:00' AND "
            f"{column} < TIMESTAMP_NTZ'{last_year + 1}-01-01 00:00:00'")


def _season_start_year(season: str | None) -> int | None:
    """'1997-98' or '1998' -> 1997 / 1998; anything else -> None (no pruning)."""
    if season and len(season) >= 4 and season[:4].isdigit():
        return int(season[:4])
    return None


def _is_range(season: str) -> bool:
    """Whether '1997-98' is exactly what the rows of its start year say."""
    y = _season_start_year(season)
    return y is not None and season == f"{y}-{(y + 1) % 100:02d}"


def _exprs(*texts: str) -> list:
    return [F.expr(t) for t in texts]


# Plans below are written as SQL expression text: each is parsed once on
# the JVM, instead of costing one driver round trip per Column node.

def _season_of_year_sql(y: str) -> str:
    """1997 -> '1997-98'; 1999 -> '1999-00'."""
    return f"concat(CAST({y} AS STRING), '-', lpad(CAST(({y} + 1) % 100 AS STRING), 2, '0'))"


def player_stats(spark: SparkSession, sf_dir: str, season: str | None = None) -> DataFrame:
    """One supplier = one player; one ship year = one season.

    With ``season`` the table holds that season only, and the season's
    ship-date range is applied at the scan, before aggregating, as a
    season-partitioned processed table would prune its folders.
    """
    li = read_table(spark, sf_dir, "lineitem")
    y0 = _season_start_year(season)
    if y0 is not None:
        li = li.where(_year_range("l_shipdate", y0, y0))
    li = li.selectExpr(
        "l_suppkey AS player_id", "year(l_shipdate) AS y", "l_orderkey", "l_linenumber",
        "l_quantity", "l_tax", "l_discount", "l_returnflag", "l_linestatus")
    # Games (distinct orders) are counted apart from the sums: the only
    # exchange that sees every row then carries three key columns, not
    # every partial sum, and it is keyed by order, so a hot supplier is
    # spread. Both sides end with one row per player and season.
    games = (li.select("player_id", "y", "l_orderkey").distinct()
             .groupBy("player_id", "y").agg(F.expr("CAST(count(1) AS INT) AS gp")))
    totals = li.groupBy("player_id", "y").agg(*_exprs(
        "sum(l_quantity) AS pts",
        "sum(l_linenumber) AS ast",
        "sum(CASE WHEN l_linestatus = 'O' THEN 6 ELSE 3 END) AS reb",
        "sum(round(l_tax * 100)) AS stl",
        "sum(round(l_discount * 100)) AS blk",
        "count_if(l_returnflag = 'N') AS fgm",
        "count(1) AS fga",
        "count_if(l_linestatus = 'F' AND l_returnflag = 'R') AS ftm",
        "count_if(l_linestatus = 'F') AS fta",
        "count_if(l_quantity >= 40 AND l_returnflag = 'A') AS tpm",
        "count_if(l_quantity >= 40) AS tpa")).join(games, ["player_id", "y"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    supplier = (read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    j = totals.join(supplier, F.col("player_id") == F.col("s_suppkey"))
    out = j.selectExpr(
        "CAST(player_id AS BIGINT) AS player_id",
        "s_name AS player_name",
        "n_name AS team_abbreviation",
        "gp AS games_played",
        "fga / gp * 10 AS minutes_per_game",
        "pts / gp AS points_per_game",
        "ast / gp AS assists_per_game",
        "reb / gp AS rebounds_per_game",
        "stl / gp AS steals_per_game",
        "blk / gp AS blocks_per_game",
        "try_divide(fgm, nullif(fga, 0)) AS field_goal_pct",
        "try_divide(tpm, nullif(tpa, 0)) AS three_point_pct",
        "try_divide(ftm, nullif(fta, 0)) AS free_throw_pct",
        "(pts + ast + reb + stl + blk - (fga - fgm) - (fta - ftm)) / gp AS efficiency_rating",
        "pts / (2 * (fga + 0.44D * fta)) AS true_shooting_pct",
        f"{_season_of_year_sql('y')} AS season",
    )
    # a season text that the range doesn't stand for matches nothing or only itself
    return out if season is None or _is_range(season) else out.where(F.col("season") == season)


def team_standings(spark: SparkSession, sf_dir: str, season: str | None = None) -> DataFrame:
    """One nation = one team; one order year = one season (``season`` as in
    ``player_stats``)."""
    o = read_table(spark, sf_dir, "orders")
    y0 = _season_start_year(season)
    if y0 is not None:
        o = o.where(_year_range("o_orderdate", y0, y0))
    o = o.selectExpr(
        "o_custkey", "year(o_orderdate) AS y", "o_orderstatus = 'F' AS won",
        "o_orderstatus = 'O' AS lost", "o_orderpriority < '3' AS home",
        # money in exact cents: sums are exact and independent of partitioning
        "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
    # Partial standings per customer and year; sums of these are exact.
    per_customer = o.groupBy("o_custkey", "y").agg(*_exprs(
        "count_if(won) AS w", "count_if(lost) AS l",
        "sum(CASE WHEN won THEN cents END) AS pf", "sum(CASE WHEN lost THEN cents END) AS pa",
        "count_if(won AND home) AS hw", "count_if(lost AND home) AS hl",
        "count_if(won AND NOT home) AS aw", "count_if(lost AND NOT home) AS al"))
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    per_nation = (per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey", "y")
                  .agg(*_exprs(*[f"sum({c}) AS {c}"
                                 for c in ("w", "l", "pf", "pa", "hw", "hl", "aw", "al")])))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    t = per_nation.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    t = t.selectExpr("*", "try_divide(w, nullif(w + l, 0)) AS _win_pct",
                     "CAST(pf AS DOUBLE) / 100 / 1000 / nullif(w, 0) AS _ppg",
                     "CAST(pa AS DOUBLE) / 100 / 1000 / nullif(l, 0) AS _oppg")
    out = t.selectExpr(
        "CAST(n_nationkey AS BIGINT) AS team_id",
        "r_name AS team_city",
        "n_name AS team_name",
        "n_name AS team_abbreviation",
        "CASE WHEN n_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS conference",
        "r_name AS division",
        "CAST(w AS INT) AS wins",
        "CAST(l AS INT) AS losses",
        "CAST(w AS INT) + CAST(l AS INT) AS total_games",
        "_win_pct AS win_pct",
        f"{tier_label_sql('_win_pct')} AS win_pct_label",
        "format_string('%d-%d', hw, hl) AS home_record",
        "format_string('%d-%d', aw, al) AS away_record",
        "CAST(NULL AS STRING) AS last_10_record",
        "_ppg AS points_per_game",
        "_oppg AS opp_points_per_game",
        "_ppg - _oppg AS point_differential",
        "_ppg - _oppg AS net_rating",
        "CAST(y AS STRING) AS season",
    )
    return out if season is None or season == str(y0) else out.where(F.col("season") == season)


def shot_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event = one shot attempt. Narrow: no shuffle at all."""
    e = read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type",
        "try_cast(regexp_extract(props, '([0-9]+)', 1) AS INT) % 40 AS dist",
        "(hour(ts) * 60 + minute(ts)) % 48 AS gm",
        "CAST(event_id % 500 - 250 AS INT) AS loc_x",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 1 "
        "WHEN event_type = 'error' THEN CAST(NULL AS INT) ELSE 0 END AS flag")
    return e.selectExpr(
        "CAST(to_date(ts) AS STRING) AS game_id",
        "CAST(user_id AS BIGINT) AS player_id",
        "concat('Player ', CAST(user_id AS STRING)) AS player_name",
        "CAST(NULL AS BIGINT) AS team_id",
        "CAST(NULL AS STRING) AS team_name",
        "CAST(floor(gm / 12) + 1 AS INT) AS period",
        "CAST(11 - gm % 12 AS INT) AS minutes_remaining",
        "0 AS seconds_remaining",
        "event_type",
        "event_type AS action_type",
        "CASE WHEN dist >= 23 THEN '3PT Field Goal' ELSE '2PT Field Goal' END AS shot_type",
        "CASE WHEN dist < 8 THEN 'Restricted Area' WHEN dist < 23 THEN 'Mid-Range' "
        "ELSE 'Above the Break 3' END AS shot_zone_basic",
        "CASE WHEN loc_x < -83 THEN 'Left' WHEN loc_x < 83 THEN 'Center' ELSE 'Right' END "
        "AS shot_zone_area",
        "CAST(dist AS INT) AS shot_distance",
        "loc_x",
        "CAST(event_id % 470 - 47 AS INT) AS loc_y",
        "flag AS shot_made_flag",
        f"{zone_label_sql('dist')} AS shot_zone_label",
        f"{made_label_sql('flag')} AS made_label",
        "CASE WHEN dayofmonth(ts) <= 15 THEN '2023-24' ELSE '2024-25' END AS season",
    )


def event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily snapshots: ``date`` is the event's day."""
    return read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "to_date(ts) AS date")


STANDINS = {
    "player_stats": player_stats,
    "team_standings": team_standings,
    "shot_charts": shot_charts,
}
