"""Joining a streamed table's many small files to files of a target size.

The stream leaves a folder a season and batch. ``compact`` rewrites the rows of all complete loads up
to the newest one into one new folder, dealt by season and clustered, in as many files as their
bytes ask for, on disk and in the memory of the task that sorts a file; ``load`` becomes a column of the rows, so deliveries and corrections mean what they
meant. Rows that a later delivery has replaced are left out. A manifest with the folder and the last load in it is
written when the rows are complete, and is the switch: ``read_streamed`` takes rows up to that
load from the folder and later ones from the stream's own. A run that fails before its
manifest changes nothing, and a rerun starts again in a folder of its own. The folders that a
compaction stands for are deleted by ``drop_loads``, later, when no reader still uses them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.sinks.files import write_processed

TARGET_BYTES = 128 << 20
#: Bytes of rows, as Spark holds them, that one task sorts. Columns that compress well
#: would else bring a task ten times the file's bytes and more.
SORT_BYTES = 256 << 20
#: What a season's rows are sorted by within the compacted files.
CLUSTERS = {"player_stats": ["player_id"], "team_standings": ["team_id"], "shot_charts": ["player_name"]}


def _listing(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])


def compactions(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(last load, folder) of the complete compactions, oldest first."""
    done = _listing(spark, f"{out}/_compacted/done/*/_SUCCESS")
    order = {s.getPath().getParent().toString(): s.getModificationTime() for s in done}
    found = []
    for place, at in order.items():
        upto, key = place.rsplit("/", 1)[1].split("-")
        found.append((int(upto), at, f"{out}/_compacted/rows/{key}"))
    return [(upto, folder) for upto, _, folder in sorted(found)]


def small_files(spark: SparkSession, out: str) -> DataFrame:
    """``season, files, bytes`` of the stream's own folders, from file sizes alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{out}/season=*/load=*").select("path", "length")
    season = F.try_url_decode(F.regexp_extract("path", "/season=([^/]+)/", 1))
    return files.groupBy(season.alias("season")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in a sort: 8 a field and for the null bits, texts in steps of 8 beside them, and a pointer with its sort key."""
    texts = [F.coalesce(F.ceil(F.octet_length(c) / 8) * 8, F.lit(0)) for c, t in df.dtypes if t == "string"]
    return reduce(Column.__add__, texts, F.lit(8 * (len(df.columns) + 4)).cast("bigint"))


def compact(spark: SparkSession, out: str, dataset: str, target: int = TARGET_BYTES, least_files: int = 2) -> str | None:
    """Rewrite all complete loads as files of about ``target`` bytes, of fewer where their rows take more than
    ``SORT_BYTES`` of memory; returns the folder, or None if no season
    has ``least_files`` files that are on average smaller than half the target."""
    from courtside.streaming.landing_stream import read_deliveries, read_streamed

    loads = _listing(spark, f"{out}/season=*/load=*")
    if not loads:
        return None
    sizes = small_files(spark, out)
    if sizes.where((F.col("files") >= least_files) & (F.col("bytes") < F.col("files") * (target // 2))).isEmpty():
        return None
    upto = read_deliveries(spark, out, dataset).agg(F.max("load")).first()[0]
    if upto is None:
        return None
    rows = read_streamed(spark, out, dataset).where(F.col("load") <= upto)
    earlier = [spark._jvm.org.apache.hadoop.fs.Path(f) for _, f in compactions(spark, out)[-1:]]
    size = sizes.agg(F.sum("bytes")).first()[0] + sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in earlier)
    held = rows.agg(F.sum(_row_bytes(rows))).first()[0] or 0
    key = uuid.uuid4().hex[:12]
    folder = f"{out}/_compacted/rows/{key}"
    write_processed(rows, folder, cluster_by=CLUSTERS[dataset], ranges=max(1, -(-size // target), -(-held // SORT_BYTES)))
    spark.createDataFrame([(upto, folder)], "upto bigint, folder string").coalesce(1).write.parquet(f"{out}/_compacted/done/{upto}-{key}")
    return folder


def drop_loads(spark: SparkSession, out: str) -> int:
    """Delete the stream's folders that the newest compaction stands for, and older compactions; returns
    how many folders. A load that came after the compaction is never touched."""
    known = compactions(spark, out)
    if not known:
        return 0
    upto, newest = known[-1]
    gone = [s.getPath() for s in _listing(spark, f"{out}/season=*/load=*") if int(s.getPath().getName().split("=")[1]) <= upto]
    gone += [spark._jvm.org.apache.hadoop.fs.Path(f) for _, f in known[:-1] if f != newest]
    for p in gone:
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(gone)
