"""History of the landed files' headers: when each spelling of a column came, where it stood, when it went.

Only first lines are read: the file list comes from file names and sizes, dealt over tasks, and each task opens
its files in their store (any that pyarrow opens: local, HDFS, S3, GCS) and stops at the first line end. Then gaps and islands over the days on which
a dataset landed give a row per dataset, column, spelling, position and unbroken run of such days.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.sources.landing import landing_targets
from courtside.sources.records import fields

#: Bytes that are read at a time until a line ends.
BLOCK = 4096
#: Files that one task opens, about.
FILES_PER_TASK = 2_000


def _first_line(path: str) -> str | None:
    from pyarrow.fs import FileSystem

    place = path if "://" in path or ":" not in path.split("/")[0] else path.replace(":", "://", 1)
    store, name = FileSystem.from_uri(place)
    found = b""
    with store.open_input_stream(name, buffer_size=BLOCK) as f:
        while b"\n" not in found and (block := f.read(BLOCK)):
            found += block
    return found.split(b"\n")[0].decode("utf-8", "replace") if found else None


def file_headers(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """``path, season, date, header`` of every landed file of a dataset."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
             .load(f"{root.rstrip('/')}/{dataset}").select("path"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [_first_line(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "header"])

    tasks = 1 + files.count() // FILES_PER_TASK
    lines = files.repartition(tasks).mapInArrow(read, "path string, header string")
    def folder(name: str):
        return F.try_url_decode(F.nullif(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("")))
    return lines.select("path", folder("season").alias("season"), folder("date").try_cast("date").alias("date"),
                        F.regexp_replace("header", "^﻿|\r$", "").alias("header"))


def column_history(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """``dataset, column, spelling, position, first_day, last_day, days`` of every run of landing days.

    ``column`` is the library's name for it, NULL for columns it doesn't know; ``position`` counts from 1; ``days``
    are those on which the dataset landed. A spelling that is gone on a landing day and comes
    back later has two rows."""
    heads = file_headers(spark, root, dataset).where("header IS NOT NULL AND date IS NOT NULL").select("date", "header").distinct()
    commas = F.length("header") - F.length(F.replace("header", F.lit(","), F.lit("")))
    width = 1 + (heads.agg(F.max(commas)).first()[0] or 0)
    found = (heads.select("date", F.posexplode(fields(F.col("header"), width)).alias("at", "spelling")).where("spelling IS NOT NULL")
             .select("date", F.trim("spelling").alias("spelling"), (F.col("at") + 1).alias("position")).distinct())
    targets, _ = landing_targets(dataset)
    names = spark.createDataFrame([(c.lower(), t) for t, candidates in targets.items() for c in candidates], "_name string, column string").distinct()
    known = found.join(F.broadcast(names), F.lower("spelling") == F.col("_name"), "left").drop("_name")  # the fixed candidates
    # landing days are numbered; in a run of them, number less rank is the same for all
    numbers = heads.select("date").distinct().select("date", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date")).alias("day"))  # a row a day
    own = Window.partitionBy("column", "spelling", "position").orderBy("date")
    runs = known.join(numbers, "date").withColumn("run", F.col("day") - F.row_number().over(own))
    return (runs.groupBy("column", "spelling", "position", "run").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count(F.lit(1)).alias("days"))
            .select(F.lit(dataset).alias("dataset"), "column", "spelling", "position", "first_day", "last_day", "days"))
