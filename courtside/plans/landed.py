"""Landing round trips and tables over data Spark derives from the driver tables.

The stand-in tables are landed the way the upstream feed lands them:
headered CSV under ``season=/date=`` folders, upstream column names whose
spelling and order drift between days, one older snapshot with stale
values, shots also one folder per player, unknown columns, quoted text.
Reading them back through ``read_landing`` -> ``process`` must give the
stand-in table again. Then the processed side: Parquet write, catalog,
added columns, manifest, results, stream.

Files go to a fresh folder under the session's shared checkpoint folder;
a deployment removes old ones with its checkpoint clean-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.plans import players as P
from courtside.plans.normalize import build_processed, process
from courtside.plans.pipeline import run_daily
from courtside.plans.templates import NAMED, run_query
from courtside.schemas import PLAYER_COLUMNS, SHOT_COLUMNS, STANDINGS_COLUMNS
from courtside.session import scratch_path
from courtside.sinks.files import Entities, land_all, land_snapshot, save_result, write_processed
from courtside.sources import standins
from courtside.sources.headers import column_history
from courtside.sources.landing import read_landing, tracked_players
from courtside.sources.processed import read_processed, register_table
from courtside.streaming import compact, drop_loads, read_deliveries, read_streamed, stream_landing

OLD_DATE, NEW_DATE = "2025-01-01", "2025-01-02"


def _spelling(columns: dict, version: int, order: list[str]) -> list[tuple[str, str]]:
    """(canonical, upstream) names: the first or the last upstream spelling of each column."""
    return [(c, columns[c][min(version, len(columns[c]) - 1)]) for c in order]


_TEAM_ORDER = list(STANDINGS_COLUMNS)
# the second feed version also swaps wins and losses
STANDINGS_A = _spelling(STANDINGS_COLUMNS, 1, _TEAM_ORDER)
STANDINGS_B = _spelling(STANDINGS_COLUMNS, 2, [{"wins": "losses", "losses": "wins"}.get(c, c) for c in _TEAM_ORDER])
PLAYERS_A = _spelling(PLAYER_COLUMNS, 0, list(PLAYER_COLUMNS))
PLAYERS_B = _spelling(PLAYER_COLUMNS, 1, list(PLAYER_COLUMNS)[::-1])


def _as_upstream(df: DataFrame, names) -> DataFrame:
    return df.select(*[F.col(c).alias(u) for c, u in names], "season")


def l_teams(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Standings landed on two days under two header versions, read back: the newest folder only."""
    teams = standins.team_standings(spark, sf_dir)
    root = scratch_path(spark, "landed")
    stale = teams.withColumn("wins", F.col("wins") - 1)
    land_snapshot(_as_upstream(stale, STANDINGS_A), root, "team_standings", None, OLD_DATE)
    land_snapshot(_as_upstream(teams, STANDINGS_B), root, "team_standings", None, NEW_DATE)
    return build_processed(spark, root, "team_standings", season=season)


def _upstream_shots(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(c.upper()) if c != "player_id" else F.col(c) for c in SHOT_COLUMNS], "season",
                     *[c for c in df.columns if c == "date"])


def l_shots(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """All shots landed on two days in one write, the newer day read back per player."""
    shots = standins.shot_charts(spark, sf_dir)
    root = scratch_path(spark, "landed")
    days = shots.withColumn("date", F.explode(F.array(F.lit(OLD_DATE), F.lit(NEW_DATE))))
    stale = days.withColumn("shot_distance", F.col("shot_distance") + F.when(F.col("date") == OLD_DATE, 1).otherwise(0))
    land_snapshot(_upstream_shots(stale), root, "shot_charts", None, None)
    return process(read_landing(spark, root, "shot_charts", season=season), "shot_charts")


def l_players(spark: SparkSession, sf_dir: str, season: str, attempts: bool = True) -> DataFrame:
    """Player averages landed on two days, names with commas and doubled quotes, one unknown
    column, and with or without the attempts that true shooting needs; read back."""
    players = standins.player_stats(spark, sf_dir).where("games_played > 0")
    quoted = players.withColumn("player_name", F.concat(F.lit('Al "Ace", '), F.col("player_name")))
    more = [F.lit("new").alias("WINGSPAN")] + ([F.col("points_per_game").alias("FGA"), F.lit(0.0).alias("FTA")] if attempts else [])
    root = scratch_path(spark, "landed")
    land_snapshot(_as_upstream(quoted.withColumn("games_played", F.lit(0)), PLAYERS_A), root, "player_stats", None, OLD_DATE)
    newer = _as_upstream(quoted, PLAYERS_B)
    extra = quoted.select(*[F.col(c).alias(u) for c, u in PLAYERS_B], *more, "season")
    land_snapshot(extra if more else newer, root, "player_stats", None, NEW_DATE)
    return build_processed(spark, root, "player_stats", season=season)


def l_lossless(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Shots with bad and huge player ids, quoted names and an unknown column: every row comes back,
    also those landed again in the players' own folders on the same day."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    odd = shots.withColumns({
        "player_id": F.expr("CASE WHEN loc_x % 3 = 0 THEN 'n/a' WHEN loc_x % 3 = 1 THEN CAST(9007199254740993 + player_id AS STRING) "
                            "ELSE CAST(player_id AS STRING) END"),
        "player_name": F.concat(F.col("player_name"), F.lit(' "Jr", the')), "scout": F.lit("x")})
    root = scratch_path(spark, "landed")
    upstream = odd.select(*[F.col(c).alias(c.upper()) for c in SHOT_COLUMNS], F.col("scout"), "season")
    land_snapshot(upstream, root, "shot_charts", None, NEW_DATE)
    again = odd.where("player_id <> 'n/a'").select(*SHOT_COLUMNS, "season")
    land_snapshot(again, root, "shot_charts", None, NEW_DATE, by_player=True)
    out = build_processed(spark, root, "shot_charts", season=season)
    return (out.groupBy("player_id", "player_name", "made_label").agg(F.count(F.lit(1)).alias("shots"), F.sum("shot_distance").alias("feet")))


def w_processed(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """All standings written as a processed table, one season read back (its folder alone)."""
    path = scratch_path(spark, "processed")
    write_processed(standins.team_standings(spark, sf_dir), path)
    return read_processed(spark, "team_standings", path=path).where(F.col("season") == season)


def c_added_column(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """A table registered without a column that a later season brings: the catalog shows it, NULL before."""
    path = scratch_path(spark, "processed")
    teams = standins.team_standings(spark, sf_dir)
    database = "courtside_" + path.rsplit("-", 1)[-1]
    write_processed(teams.where(F.col("season") != season).select("team_id", "wins", "season"), path)
    register_table(spark, "standings", path, database=database)
    write_processed(teams.where(F.col("season") == season).select("team_id", "wins", "losses", "season"), path)
    register_table(spark, "standings", path, database=database)
    return (read_processed(spark, "standings", database=database).groupBy(F.col("season").cast("string").alias("season"))
            .agg(F.count(F.lit(1)).alias("teams"), F.sum("wins").cast("bigint").alias("wins"), F.sum("losses").cast("bigint").alias("losses")))


def m_land_all(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """The manifest of a day: two datasets as frames, one of them empty; the season's shots of all players in
    one write, compared with every customer as the players expected."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season).drop("season")
    expected = standins.read_table(spark, sf_dir, "customer", ["c_custkey"]).withColumnRenamed("c_custkey", "player_id")
    teams = standins.team_standings(spark, sf_dir)
    got = land_all(spark, {"team_standings": teams.drop("season"), "player_stats": teams.limit(0), "shot_charts": Entities(shots, expected)},
                   scratch_path(spark, "landed"), season, NEW_DATE)
    return got.select("dataset", "entity_id", "status", "rows")


def l_multiline(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Shots whose names and action types hold line breaks, commas and doubled quotes, landed and read back."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    odd = shots.withColumns({
        "player_name": F.concat(F.col("player_name"), F.when(F.col("loc_x") % 3 == 0, F.lit(' "Jr",\nthe\n\n"2nd"')).otherwise(F.lit(""))),
        "action_type": F.concat(F.col("action_type"), F.when(F.col("loc_y") % 2 == 0, F.lit('\n, "x"\n')).otherwise(F.lit(", y")))})
    root = scratch_path(spark, "landed")
    land_snapshot(_upstream_shots(odd), root, "shot_charts", None, NEW_DATE)
    out = build_processed(spark, root, "shot_charts", season=season)
    return (out.groupBy("player_name", "action_type", "made_label")
            .agg(F.count(F.lit(1)).alias("shots"), F.sum("shot_distance").alias("feet"), F.min("game_id").alias("first_game")))


def w_daily(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Two daily runs; every fifth player is missing on the second day and keeps the first day's shots."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    teams = standins.team_standings(spark, sf_dir, "1998")
    landed, processed = scratch_path(spark, "landed"), scratch_path(spark, "processed")
    database = "courtside_" + processed.rsplit("-", 1)[-1]
    days = {OLD_DATE: (shots.withColumn("loc_x", F.col("loc_x") + 1000), teams.withColumn("wins", F.col("wins") - 1)),
            NEW_DATE: (shots.where("player_id % 5 <> 0"), teams)}
    for date, (day_shots, day_teams) in days.items():
        run_daily(spark, {"shot_charts": _upstream_shots(day_shots).drop("season"), "team_standings": _as_upstream(day_teams, STANDINGS_A).drop("season")},
                  landed, processed, season, date, database=database, datasets=("shot_charts", "team_standings"))
    by_player = (read_processed(spark, "shot_charts", database=database).where(F.col("season") == season)
                 .groupBy("player_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("loc_x").alias("total")))
    by_team = read_processed(spark, "team_standings", database=database).where(F.col("season") == season).select(
        "team_id", F.lit(1).cast("bigint").alias("rows"), F.col("wins").cast("bigint").alias("total"))
    return by_player.withColumn("kind", F.lit("player")).withColumnRenamed("player_id", "id").unionByName(
        by_team.withColumn("kind", F.lit("team")).withColumnRenamed("team_id", "id"))


def clustered_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shots written as a processed table clustered by player within a season, read back."""
    path = scratch_path(spark, "processed")
    write_processed(standins.shot_charts(spark, sf_dir), path, cluster_by=["player_name"])
    return read_processed(spark, "shot_charts", path=path)


def w_result(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """A query's result saved as Parquet and read back."""
    path = scratch_path(spark, "result")
    save_result(P.p_eff(standins.player_stats(spark, sf_dir, season), season), path)
    return spark.read.parquet(path)


def st_land(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Two runs of the landing stream; the second takes only the second day's files, of players one by one."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    root, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "streamed", "stream"))
    land_snapshot(_upstream_shots(shots.where("player_id % 2 = 0")), root, "shot_charts", None, OLD_DATE)
    stream_landing(spark, root, "shot_charts", out, checkpoint=checkpoint)
    inside = shots.where("player_id % 2 = 1").select(*SHOT_COLUMNS, F.col("season"))
    land_snapshot(inside, root, "shot_charts", None, NEW_DATE, by_player=True)
    stream_landing(spark, root, "shot_charts", out, checkpoint=checkpoint)
    rows = spark.read.parquet(out)
    return (rows.groupBy(F.col("load").cast("int").alias("load"), "shot_zone_label", "made_label")
            .agg(F.count(F.lit(1)).alias("shots"), F.countDistinct("player_id").alias("players")))


def _corrected(spark: SparkSession, sf_dir: str, season: str) -> tuple[str, str]:
    """A stream over two days, the first of them landed again for a third of its players."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    root, out, checkpoint = (scratch_path(spark, n) for n in ("landed", "streamed", "stream"))
    # bulk files a part of the players each, so that a correction has a folder's files of its own
    for date, day in ((OLD_DATE, shots), (NEW_DATE, shots.where("player_id % 2 = 0")),
                      (OLD_DATE, shots.where("player_id % 3 = 0").withColumn("shot_distance", F.col("shot_distance") + 1))):
        land_snapshot(_upstream_shots(day), root, "shot_charts", None, date)
        stream_landing(spark, root, "shot_charts", out, checkpoint=checkpoint)
    return out, season


def st_corrected(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Shots by day and load after a corrected delivery: the corrected players' first load isn't counted."""
    out, season = _corrected(spark, sf_dir, season)
    return (read_streamed(spark, out, "shot_charts").groupBy("date", "load", (F.col("player_id") % 6).cast("int").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("shots"), F.sum("shot_distance").alias("feet")))


def st_manifest(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """What the stream's loads brought: deliveries and rows by day, corrected ones included."""
    out, season = _corrected(spark, sf_dir, season)
    return (read_deliveries(spark, out, "shot_charts").groupBy("load", "date")
            .agg(F.count(F.lit(1)).alias("deliveries"), F.sum("rows").alias("rows")))


def w_compact(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """The corrected stream's rows after its loads were joined to files of a target size and dropped."""
    out, _ = _corrected(spark, sf_dir, season)
    compact(spark, out, "shot_charts")
    drop_loads(spark, out)
    return (read_streamed(spark, out, "shot_charts").groupBy("date", "load", "made_label")
            .agg(F.count(F.lit(1)).alias("shots"), F.sum("shot_distance").alias("feet"), F.sum("loc_x").alias("x")))


def h_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each spelling of a shot column was used: every game day lands by itself, the second third of
    a month with lower-case names in reverse order."""
    shots = standins.shot_charts(spark, sf_dir).withColumn("date", F.col("game_id"))
    root = scratch_path(spark, "landed")
    second = F.dayofmonth(F.col("date").cast("date")).between(11, 20)
    land_snapshot(_upstream_shots(shots.where(~second)), root, "shot_charts", None, None)
    land_snapshot(shots.where(second).select(*SHOT_COLUMNS[::-1], "season", "date"), root, "shot_charts", None, None)
    return column_history(spark, root, "shot_charts")


def x_tracked(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Shots of the tracked players, counted; the list is a table: the customers of six nations."""
    shots = standins.shot_charts(spark, sf_dir).where(F.col("season") == season)
    customers = standins.read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return tracked_players(shots, customers.where("c_nationkey < 6").select("c_custkey")).groupBy("player_id").agg(F.count(F.lit(1)).alias("shots"))


_VIEWS = {"players": standins.player_stats, "teams": standins.team_standings, "shots": standins.shot_charts}


def by_name(name: str, **params):
    """The named query through the catalog: its stand-in as a view, called with ``run_query``."""
    kind = NAMED[name][1]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = f"courtside_{kind}"
        _VIEWS[kind](spark, sf_dir).createOrReplaceTempView(view)
        return run_query(spark, name, **{kind: view}, **params)

    return query
