"""Questions by name over catalog tables, and a runner for a user's own SQL.

``run_query`` resolves the named query's table in the catalog and calls
the same DataFrame function that the registered queries use, so there is
one logic and one order of rows. ``run_sql`` runs any statement with bound
parameters (``:name``) and table names through ``IDENTIFIER(:name)``: no
value is ever spliced into the text.
"""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame, SparkSession

from courtside.plans import dashboard, players, shots, teams
from courtside.sources.processed import DEFAULT_DATABASE

#: name -> (function, kind of table)
NAMED = {
    **{n: (getattr(players, n), "players") for n in ("p_top20", "p_triple", "p_eff", "p_three")},
    **{n: (getattr(teams, n), "teams") for n in ("t_all", "t_conf", "t_off", "t_def", "t_seed")},
    **{n: (getattr(shots, n), "shots") for n in ("s_zone", "s_hot", "s_share", "s_clutch")},
    "d_players": (dashboard.d_players, "players"),
    "d_standings": (dashboard.d_standings, "teams"),
    "d_shooters": (dashboard.d_shooters, "shots"),
    "d_shots": (dashboard.d_shots, "shots"),
}

DEFAULT_TABLES = {"players": f"{DEFAULT_DATABASE}.player_stats",
                  "teams": f"{DEFAULT_DATABASE}.team_standings",
                  "shots": f"{DEFAULT_DATABASE}.shot_charts"}


def run_query(spark: SparkSession, name: str, **params) -> DataFrame:
    """A named query as a lazy DataFrame.

    ``players`` / ``teams`` / ``shots`` name the table (catalog name or temp
    view; default the ``processed`` database); the rest are the query's own
    parameters. A parameter it doesn't have is an error.
    """
    function, kind = NAMED[name]
    known = list(inspect.signature(function).parameters)[1:]
    table = params.pop(kind, DEFAULT_TABLES[kind])
    unknown = sorted(set(params) - set(known))
    if unknown:
        raise TypeError(f"{name} has no parameter {unknown}; it takes {[kind, *known]}")
    return function(spark.table(table), **params)


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """A user's own statement with bound parameters."""
    return spark.sql(text, args=params)
