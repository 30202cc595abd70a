"""Incremental pickup of newly landed snapshot files.

The daily landing becomes a file stream: each run (``availableNow``)
processes only the files that arrived since the last one, recorded in a
checkpoint under the session's shared checkpoint folder, and adds them,
typed and derived, to a season-partitioned Parquet table. The stream is
stateless; choosing the newest snapshot stays a batch step downstream
(``courtside.operators.latest_snapshot``), so no streaming state grows
with the data.

Each micro-batch reads its files as lines and binds its records to their own
file's header, as the batch reader does: any header version, line breaks in quoted
fields, ``season`` inside the file or not, one file per player or one for all. A batch
writes to a ``load=<batch>`` partition of its seasons and replaces only that, so a batch
that is retried after a failure doesn't count twice.

A day may be landed again with corrected values. Each batch therefore also
writes its deliveries: a row per season, date and (for shots) player it brought, with the
rows counted, under ``_deliveries/load=<batch>`` of the table, after its rows. ``read_streamed``
keeps the rows of each key's newest delivery. A player's file without any row is a delivery too: it takes
the player's earlier rows of that day away. Rows of a batch that failed before its
deliveries were written belong to no delivery and aren't seen. A file overwritten under its own name is
the same file to the stream; corrections come as files of their own, as ``land_snapshot`` writes them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.plans.normalize import _STEPS
from courtside.session import checkpoint_root
from courtside.sources.landing import bind_by_header, landing_targets
from courtside.sources.records import mixed_lines, part_facts
from courtside.streaming.compaction import _listing, compactions

#: What one delivery covers.
DELIVERY_KEYS = {"player_stats": ["season", "date"], "team_standings": ["season", "date"], "shot_charts": ["season", "date", "player_id"]}
_TYPES = {"season": "string", "date": "date", "player_id": "bigint"}


def _deliveries(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Key and rows of all that a batch brought: keys of its rows, and those that its paths name."""
    counted = rows.groupBy(*[F.col(k).cast(_TYPES[k]).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    named = {"season": F.col("_season"), "date": F.col("_date"), "player_id": F.coalesce("_player_id", "_file_player")}
    paths = facts.select(*[named[k].try_cast(_TYPES[k]).alias(k) for k in keys], F.lit(0).cast("bigint").alias("rows")).na.drop(subset=keys)
    return counted.unionByName(paths).groupBy(*keys).agg(F.sum("rows").alias("rows"))


def stream_landing(spark: SparkSession, root: str, dataset: str, out: str,
                   checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                   wait: bool = True) -> StreamingQuery:
    """Process every landed file not seen before and add it to ``out``."""
    if checkpoint is None:
        checkpoint = os.path.join(checkpoint_root(spark), "courtside", "streams", dataset)
    reader = (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
              .format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    targets, optional = landing_targets(dataset)
    normalize, derive, schema = _STEPS[dataset]
    keys = DELIVERY_KEYS[dataset]

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        lines = mixed_lines(batch)
        facts = part_facts(lines)
        rows = bind_by_header(lines, facts, targets, {*optional, "player_id"} if dataset == "shot_charts" else optional)
        if "player_id" in rows.columns:
            rows = rows.withColumn("player_id", F.coalesce("player_id", "_player_id"))
        typed = derive(normalize(rows.drop("_player_id"))).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], "date", F.lit(number).cast("bigint").alias("load"))
        written = Observation(f"load_{number}")
        _replace(typed.observe(written, F.count(F.lit(1)).alias("rows")), out, "season", "load")
        count = written.get["rows"]
        there = (session.read.schema(typed.schema).parquet(out).where(F.col("load") == number) if count else typed.limit(0))
        brought = _deliveries(there, facts, keys).withColumn("load", F.lit(number).cast("bigint"))
        _replace(brought, f"{out}/_deliveries", "load")
        found = read_deliveries(session, out, dataset).where(F.col("load") == number).agg(F.sum("rows")).first()[0] or 0
        if found != count:
            raise RuntimeError(f"load {number} wrote {count} rows, its deliveries name {found}")

    raw = reader.load(f"{root.rstrip('/')}/{dataset}").select("path", "content", "_metadata")
    q = (raw.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def _replace(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def read_deliveries(spark: SparkSession, out: str, dataset: str) -> DataFrame:
    """Season, date, (player,) rows and load of every delivery that the stream has taken."""
    schema = ", ".join(f"{k} {_TYPES[k]}" for k in DELIVERY_KEYS[dataset]) + ", rows bigint, load bigint"
    return spark.read.schema(schema).parquet(f"{out}/_deliveries")


def read_streamed(spark: SparkSession, out: str, dataset: str) -> DataFrame:
    """The streamed table's rows of each key's newest delivery, with their ``load``, compacted
    or not. The delivery table has a row a key and load; the planner broadcasts it where it is small."""
    keys = DELIVERY_KEYS[dataset]
    _, _, schema = _STEPS[dataset]
    newest = read_deliveries(spark, out, dataset).groupBy(*keys).agg(F.max("load").alias("_load")).select(*[F.col(k).alias(f"_{k}") for k in keys], "_load")
    on = F.col("load") == F.col("_load")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ", date date, load bigint"
    known = compactions(spark, out)
    loads = _listing(spark, f"{out}/season=*/load=*")
    rows = spark.read.schema(columns).parquet(out) if loads else spark.createDataFrame([], columns)
    if known:
        upto, folder = known[-1]
        rows = rows.where(F.col("load") > upto).unionByName(spark.read.schema(columns).parquet(folder))
    return rows.join(newest, on, "left_semi")
