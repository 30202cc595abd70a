"""The daily run as one function: land -> process -> write -> publish.

``land_all`` writes the day's frames and returns the manifest; then each
dataset's processed season is brought up to date from the day's landing
folder (name binding, typing, derived columns, newest snapshot), written
as a new version, and published by one catalog switch
(``courtside.sinks.publish``): readers see the old season until then and the
whole new one from then on. Each step is a distributed Spark job over files
in shared storage, so a rerun after a failure redoes the day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.plans.normalize import SNAPSHOT_KEYS, process
from courtside.session import scratch_path
from courtside.sinks.files import land_all, run_date
from courtside.sinks.publish import current, publish, read_published
from courtside.sources.landing import read_landing
from courtside.sources.processed import DEFAULT_DATABASE

DATASETS = ("player_stats", "team_standings", "shot_charts")
#: What a season's files are sorted by: a large season is read one player at a time.
CLUSTERS = {"player_stats": (), "team_standings": (), "shot_charts": ("player_name",)}


def run_daily(spark: SparkSession, frames: Mapping, landing_root: str, processed_root: str,
              season: str, date: str | None = None, database: str = DEFAULT_DATABASE,
              datasets=DATASETS) -> DataFrame:
    """Land the day's frames, bring the processed tables of ``season`` up to
    date and publish them; returns the landing manifest.

    Only datasets that landed rows today are touched: league-wide tables are
    rebuilt from the newest date folder alone, and shots are the day's rows
    plus the earlier version's rows of players that didn't land today, so
    no run reads the landing history again. A dataset is published as soon as it is
    written; a failure leaves the others, and its own last version, as they are.
    """
    date = date or run_date()
    path = scratch_path(spark, "manifest")
    land_all(spark, frames, landing_root, season, date).write.parquet(path)
    manifest = spark.read.parquet(path)
    landed = {r["dataset"] for r in manifest.where("status = 'success'").select("dataset").distinct().toLocalIterator()}
    for ds in datasets:
        if ds not in landed:
            continue  # earlier snapshots stay as they are; the manifest says why
        path = f"{processed_root.rstrip('/')}/{ds}"
        df = process(read_landing(spark, landing_root, ds, season=season, date=date), ds, newest_only=False)
        if len(SNAPSHOT_KEYS[ds]) > 1:
            df = _with_earlier(spark, df, path, season, current(spark, ds, path, database))
        publish(df, ds, path, database=database, cluster_by=CLUSTERS[ds])
    return manifest


def _with_earlier(spark: SparkSession, day: DataFrame, path: str, season: str, version: int | None) -> DataFrame:
    """The day's rows and those of the published season whose player isn't among them. The
    earlier version stays while the new one is written, so nothing has to be copied first."""
    if version is None:
        return day
    earlier = read_published(spark, path, version).where(F.col("season") == season).select(
        *[F.col(f.name).cast(f.dataType) for f in day.schema.fields])
    today = day.select(F.col("player_id").alias("_today")).distinct()
    kept = earlier.join(today, F.col("player_id").eqNullSafe(F.col("_today")), "left_anti")
    return day.unionByName(kept)
