"""Writers: landed CSV snapshots, the landing manifest, processed Parquet,
query results.

Every write is an overwrite of exactly the partitions it touches
(dynamic partition overwrite), so a rerun after a lost executor or a
failed job replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtside.session import scratch_path
from courtside.sinks.folders import CSV, write_folders
from courtside.sources.player_files import player_counts
from courtside.stores import store_uri

MANIFEST_SCHEMA = ("dataset string, entity_id bigint, status string, rows bigint, "
                   "path string, message string")


def _dynamic(df: DataFrame):
    return (df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic"))


def snapshot_path(root: str, dataset: str, season: str, date: str,
                  entity_id: int | None = None) -> str:
    p = f"{root.rstrip('/')}/{dataset}/season={season}/date={date}"
    return p if entity_id is None else f"{p}/player_id={entity_id}"


def land_snapshot(df: DataFrame, root: str, dataset: str, season: str | None, date: str | None,
                  by_player: bool = False) -> str:
    """Write one snapshot as headered CSV under ``season=/date=`` (and
    ``player_id=`` for per-player shot files), replacing only those
    partitions. Landing players one after another keeps the others.
    ``season=None`` / ``date=None`` take each row's own column (many seasons
    or days in one distributed write). Quotes in text are doubled."""
    parts = ["season", "date"] + (["player_id"] if by_player else [])
    out = df
    for name, value in (("season", season), ("date", date)):
        if value is not None:
            out = out.withColumn(name, F.lit(value))
        elif name not in df.columns:
            raise KeyError(f"{name}=None needs a {name!r} column")
    base = f"{root.rstrip('/')}/{dataset}"
    place = store_uri(df.sparkSession, base) if by_player else None
    if place is not None:
        write_folders(out, base, place, parts)
    else:
        if by_player:  # a few files a player, more for a player with much
            out = out.hint("rebalance", F.col("player_id"))
        _dynamic(out).option("header", True).options(**CSV).partitionBy(*parts).csv(base)
    return snapshot_path(root, dataset, season or "*", date or "*")


def _land_one(dataset: str, df: DataFrame, root: str, season: str, date: str) -> tuple:
    try:
        if df.isEmpty():
            return (dataset, None, "empty", 0, None, "no rows; nothing written")
        obs = Observation(f"land_{dataset}")
        land_snapshot(df.observe(obs, F.count(F.lit(1)).alias("rows")), root, dataset, season, date)
        return (dataset, None, "success", int(obs.get["rows"]), snapshot_path(root, dataset, season, date), None)
    except Exception as e:  # one failure must not stop the other datasets; the manifest has all of it
        return (dataset, None, "error", None, None, f"{type(e).__name__}: {e}")


class Entities(NamedTuple):
    """One frame with the rows of many entities (``player_id``), landed a folder each. ``expected``, a
    frame with a ``player_id`` column, names those whose absence is recorded as ``empty``."""

    frame: DataFrame
    expected: DataFrame | None = None


def landed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``entity_id, rows`` of what lies in the per-player folders under ``folder``, as a reader sees it."""
    return (player_counts(spark, [folder]).select(F.col("_player_id").try_cast("bigint").alias("entity_id"), "n")
            .groupBy("entity_id").agg(F.sum("n").alias("rows")))


def _land_entities(dataset: str, value: Entities, root: str, season: str, date: str) -> DataFrame:
    """All entities' rows in one write partitioned by entity; what has landed is counted by Spark and compared
    with the expected ids. Neither ids nor counts pass through the driver."""
    frame, expected = value
    spark = frame.sparkSession
    folder = snapshot_path(root, dataset, season, date)
    wanted = None if expected is None else expected.select(F.col("player_id").cast("bigint").alias("entity_id")).distinct()

    def manifest(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(dataset).alias("dataset"), "entity_id", "status", "rows", "path", "message")

    try:
        written = Observation(f"land_{dataset}")
        land_snapshot(frame.observe(written, F.count(F.lit(1)).alias("rows")), root, dataset, season, date, True)
        total = written.get["rows"]
        schema = "entity_id bigint, rows bigint"
        counted = landed_counts(spark, folder) if total else spark.createDataFrame([], schema)
        place = scratch_path(spark, "landed_counts")
        counted.write.parquet(place)
        counted = spark.read.schema(schema).parquet(place)
        found = counted.agg(F.sum("rows")).first()[0] or 0
        if found < total:
            raise RuntimeError(f"{total} rows were written, {found} are there")
    except Exception as e:
        said = f"{type(e).__name__}: {e}"
        failed = spark.createDataFrame([(None,)], "entity_id bigint") if wanted is None else wanted
        return manifest(failed.withColumns({"status": F.lit("error"), "rows": F.lit(None).cast("bigint"), "path": F.lit(None).cast("string"), "message": F.lit(said)}))
    if wanted is not None:
        ids = wanted.withColumnRenamed("entity_id", "_wanted")
        counted = ids.join(counted, F.col("_wanted").eqNullSafe(F.col("entity_id")), "full_outer").select(F.coalesce("entity_id", "_wanted").alias("entity_id"), "rows")
    there = F.col("rows").isNotNull()
    return manifest(counted.withColumns({
        "status": F.when(there, "success").otherwise("empty"), "rows": F.coalesce("rows", F.lit(0)).cast("bigint"),
        "path": F.when(there, F.concat(F.lit(f"{folder}/player_id="), F.coalesce(F.col("entity_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))),
        "message": F.when(~there, "no rows; nothing written")}))


def _tagged(frames: Mapping[int, DataFrame]) -> Entities:
    """Frames that come one a player, as one."""
    tagged = [df.withColumn("player_id", F.lit(int(i)).cast("bigint")) for i, df in frames.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return Entities(rows, rows.sparkSession.createDataFrame([(int(i),) for i in frames], "player_id bigint"))


def run_date() -> str:
    """Today's date in UTC as ``YYYY-MM-DD``: the landing folder of a run."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


def land_all(spark: SparkSession, frames: Mapping[str, DataFrame | Mapping[int, DataFrame] | Entities],
             root: str, season: str, date: str | None = None) -> DataFrame:
    """Land every dataset and return a manifest
    ``[dataset, entity_id, status, rows, path, message]``.

    ``Entities(frame, expected)`` lands the rows of any number of players in one write
    partitioned by player; expected players without a row are recorded as ``empty``, rows are
    counted on what has landed and checked against ``observe`` on the write. A mapping
    ``{player_id: frame}`` is the same for a few frames that the feed delivers one by one. A frame
    of a whole dataset that is empty is recorded and not written. One dataset's failure doesn't
    stop the others; messages are kept whole.
    """
    date = date or run_date()
    rows, more = [], []
    for dataset, value in frames.items():
        if isinstance(value, Mapping):
            if not value:
                continue
            value = _tagged(value)
        if isinstance(value, Entities):
            more.append(_land_entities(dataset, value, root, season, date))
        else:
            rows.append(_land_one(dataset, value, root, season, date))
    return reduce(DataFrame.unionByName, more, spark.createDataFrame(rows, MANIFEST_SCHEMA))


def write_processed(df: DataFrame, path: str, partition_by: Sequence[str] = ("season",),
                    max_records_per_file: int = 5_000_000, cluster_by: Sequence[str] = (),
                    ranges: int | None = None) -> None:
    """Write a processed table as Parquet partitioned by season.

    Rows are rebalanced by season: AQE cuts a large season into tasks of
    the advisory size and joins small ones, so the number of write tasks
    follows the data. ``maxRecordsPerFile`` splits files. Only the seasons
    present in ``df`` are replaced.

    With ``cluster_by`` (a player's name, say) rows are dealt by ranges of season and those columns
    instead and sorted within a file, so each file and row group holds a narrow range of them and a filter
    on one value skips the others by their statistics. A value with more rows than a range
    takes spills into the next: the ranges are drawn over the columns and a row number. Their number follows the
    input's size unless ``ranges`` gives it.
    """
    parts = list(partition_by)
    if cluster_by:
        keys = [*parts, *cluster_by]
        spread = df.withColumn("_spread", F.monotonically_increasing_id())
        out = spread.repartitionByRange(ranges or _write_tasks(df), *keys, "_spread").sortWithinPartitions(*keys).drop("_spread")
    else:
        out = df.hint("rebalance", *[F.col(c) for c in parts])
    (_dynamic(out).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*parts).parquet(path))


#: Bytes of a range that one task writes; tasks of a clustered write at most.
RANGE_BYTES, MOST_RANGES = 128 << 20, 100_000


def _write_tasks(df: DataFrame) -> int:
    """Ranges of a clustered write, by the size of what the plan reads (an estimate after joins may be
    off by any factor; the inputs' sizes are known)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(s for s in sizes if s < 1 << 60)  # larger: not known
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_RANGES, -(-read // RANGE_BYTES)))


def save_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist a query result (CSV with header, or Parquet)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
