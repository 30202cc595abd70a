"""Files in players' own folders (``season=/date=/player_id=/``), for any number of players.

Spark lists files into its driver and opens each with a reader of its own, every time it goes over
them. Here one task lists a date folder, the players' folders it found are dealt over tasks, and each task lists
its folders through pyarrow and reads their small files whole. Texts and facts are written to the session's
scratch folder once; neither names nor texts pass through the driver. Files above ``records.SMALL_BYTES``, of
which there are few for the bytes they hold, are scanned in parts. On stores that pyarrow doesn't open all is left to Spark's
``binaryFile`` (``records.player_lines``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.session import scratch_path
from courtside.sources import records
from courtside.stores import folder_tasks, store_uri

#: Characters of a path that stand as %XX in ``_metadata.file_path``.
_QUOTED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')
#: CSV files that Spark's readers see: other names are hidden.
_SEEN = re.compile(r"(?!\.|_[^=]*$).*\.csv", re.DOTALL)
#: Files beside the players' folders that are named one by one at most; bytes of texts that a task holds.
MOST_BESIDE, HELD_BYTES = 1000, 8 << 20


class PlayerFiles(NamedTuple):
    """Files of date folders: ``beside`` are the paths of those right under them (None: to be found by a pattern). Of
    those in players' folders, ``alone`` has the facts and ``_text`` of files in which every line is a record; the others
    have ``lines`` and ``facts``. None: there are none."""

    beside: list[str] | None
    alone: DataFrame | None = None
    lines: DataFrame | None = None
    facts: DataFrame | None = None

    @property
    def there(self) -> bool:
        return self.alone is not None or self.lines is not None

    def days(self) -> DataFrame:
        """Season and date of the files in players' folders."""
        return reduce(DataFrame.unionByName, [f.select("_season", "_date") for f in (self.alone, self.facts) if f is not None])


def _date_folders(spark: SparkSession, patterns: Sequence[str]) -> list[tuple[str, str | None]]:
    """Path of each folder that matches, and its place to pyarrow."""
    found = []
    for pattern in dict.fromkeys(patterns):
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
            if status.isDirectory():
                folder = status.getPath().toString()
                found.append((folder, store_uri(spark, folder)))
    return found


def _entries(spark: SparkSession, folders: list[tuple[str, str]]) -> DataFrame:
    """Players' folders and CSV files right under each date folder, written to the scratch folder."""
    seen = _SEEN

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for date, place in zip(*(c.to_pylist() for c in batch.columns)):
                store, base = FileSystem.from_uri(place)
                found = store.get_file_info(FileSelector(base))
                for at in range(0, len(found), 10_000):
                    some = [(i.base_name, i.type == FileType.Directory) for i in found[at:at + 10_000]]
                    names = [(n, True) for n, folder in some if folder and n.startswith("player_id=") and n != "player_id="]
                    names += [(n, False) for n, _ in some if seen.fullmatch(n)]
                    yield pa.RecordBatch.from_pydict({
                        "date": pa.array([date] * len(names), pa.string()), "place": pa.array([place] * len(names), pa.string()),
                        "name": pa.array([n for n, _ in names], pa.string()), "own": pa.array([own for _, own in names], pa.bool_())})

    schema = "date string, place string, name string, own boolean"
    listed = scratch_path(spark, "landed_folders")
    (spark.createDataFrame(folders, "date string, place string").repartition(folder_tasks(spark, len(folders)))
     .mapInArrow(entries, schema).write.parquet(listed))
    return spark.read.schema(schema).parquet(listed)


def _texts(folders: DataFrame) -> DataFrame:
    """``_name, _path, _text`` of the CSV files in players' folders; no text of large files."""
    seen, quoted, small, most = _SEEN, _QUOTED, records.SMALL_BYTES, HELD_BYTES

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores, rows, held = {}, [], 0

        def batch_of_rows() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_pydict({"_name": pa.array(columns[0], pa.string()), "_path": pa.array(columns[1], pa.string()),
                                               "_text": pa.array(columns[2], pa.binary())})

        for batch in batches:
            for date, place, name in zip(*(c.to_pylist() for c in batch.columns)):
                store, base = stores.get(place) or stores.setdefault(place, FileSystem.from_uri(place))
                for i in store.get_file_info(FileSelector(f"{base}/{name}")):
                    if i.type == FileType.Directory or not seen.fullmatch(i.base_name) or i.size == 0:
                        continue  # nor do Spark's readers see an empty file
                    text = None
                    if i.size <= small:
                        with store.open_input_stream(i.path) as f:
                            text = f.read()
                        held += len(text)
                    path = f"{date}/{name}/{i.base_name}"
                    rows.append((path, quoted.sub(lambda m: f"%{ord(m[0]):02X}", path), text))
                    if held > most:
                        yield batch_of_rows()
                        rows, held = [], 0
        yield batch_of_rows()

    return (folders.select("date", "place", "name").mapInArrow(texts, "_name string, _path string, _text binary")
            .withColumn("_text", F.col("_text").cast("string")))


def landed_files(spark: SparkSession, patterns: Sequence[str]) -> PlayerFiles:
    """The files under the date folders that match, in players' folders and beside them."""
    folders = _date_folders(spark, patterns)
    if any(place is None for _, place in folders):
        try:
            lines = records.player_lines(spark, list(patterns))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = None
        return PlayerFiles(None) if lines is None else PlayerFiles(None, None, lines, records.part_facts(lines))
    if not folders:
        return PlayerFiles([])
    entries = _entries(spark, folders)
    beside = [f"{r.date}/{r.name}" for r in entries.where("NOT own").limit(MOST_BESIDE + 1).collect()]
    own = entries.where("own")
    n = own.count()
    found = PlayerFiles(beside if len(beside) <= MOST_BESIDE else None)
    if not n:
        return found
    place = scratch_path(spark, "landed_texts")
    whole = records.whole_facts(_texts(own.repartition(folder_tasks(spark, n))))
    whole.write.parquet(place)
    whole = spark.read.schema(whole.schema).parquet(place)
    alone, odd, large = whole.agg(F.count_if(F.col("_odd") == 0), F.count_if(F.col("_odd") > 0), F.count_if(F.col("_text").isNull())).first()
    lines, facts = [], []
    if odd:
        broken = whole.where("_odd > 0")
        lines.append(records.whole_lines(broken))
        facts.append(broken.drop("_name", "_text"))
    if large:
        paths = records.escaped(r[0] for r in whole.where("_text IS NULL").select("_name").collect())
        lines.append(records.file_lines(spark.read.option("lineSep", "\n").text(paths)))
        facts.append(records.part_facts(lines[-1]))
    return found._replace(alone=whole.where("_odd = 0") if alone else None, lines=reduce(DataFrame.unionByName, lines) if lines else None,
                          facts=reduce(DataFrame.unionByName, facts) if facts else None)


def player_counts(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """``_player_id, n``: records in each file (part) of players' folders."""
    own = landed_files(spark, patterns)
    # counted by part first, so the player's name is looked up once a part
    parts = [own.alone.select("_player_id", (F.col("_lines") - 1).alias("n")).where("n > 0")] if own.alone is not None else []
    if own.lines is not None:
        names = own.facts.select(F.col("_path").alias("_p"), F.col("_start").alias("_s"), "_player_id")
        parts.append(records.counts(own.lines, own.facts).join(names, (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s")))
                     .select("_player_id", "n"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "_player_id string, n bigint")
