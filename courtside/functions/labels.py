"""Derived labels of the processed tables. Cut points are parameters
(defaults in ``courtside.schemas``); NULL input stays NULL. The ladders are
SQL text (one parse on the JVM); the Column forms wrap it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.schemas import (
    DEFAULT_TIERS, DEFAULT_TIER_ELSE, DEFAULT_ZONE_BOUNDS, DEFAULT_ZONE_ELSE,
    MADE_LABEL, MISSED_LABEL,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def true_shooting(points, fga, fta) -> Column:
    """Points / (2 * (FGA + 0.44 * FTA)); NULL when attempts are missing or zero."""
    return F.try_divide(_c(points), F.lit(2) * (_c(fga) + F.lit(0.44) * _c(fta)))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tier_label_sql(win_pct: str, tiers=DEFAULT_TIERS, otherwise=DEFAULT_TIER_ELSE) -> str:
    whens = " ".join(f"WHEN {win_pct} >= {b} THEN {_lit(l)}" for b, l in tiers)
    return f"CASE {whens} WHEN {win_pct} IS NOT NULL THEN {_lit(otherwise)} END"


def zone_label_sql(distance: str, bounds=DEFAULT_ZONE_BOUNDS, otherwise=DEFAULT_ZONE_ELSE) -> str:
    whens = " ".join(f"WHEN {distance} < {b} THEN {_lit(l)}" for b, l in bounds)
    return f"CASE {whens} WHEN {distance} IS NOT NULL THEN {_lit(otherwise)} END"


def made_label_sql(flag: str) -> str:
    return (f"CASE WHEN {flag} = 1 THEN {_lit(MADE_LABEL)} "
            f"WHEN {flag} = 0 THEN {_lit(MISSED_LABEL)} END")


def tier_label(win_pct: str, tiers=DEFAULT_TIERS, otherwise=DEFAULT_TIER_ELSE) -> Column:
    """``win_pct_label``: first tier whose lower bound is reached."""
    return F.expr(tier_label_sql(win_pct, tiers, otherwise))


def zone_label(distance: str, bounds=DEFAULT_ZONE_BOUNDS, otherwise=DEFAULT_ZONE_ELSE) -> Column:
    """``shot_zone_label``: first bucket whose upper bound exceeds the distance."""
    return F.expr(zone_label_sql(distance, bounds, otherwise))


def made_label(flag: str) -> Column:
    return F.expr(made_label_sql(flag))
