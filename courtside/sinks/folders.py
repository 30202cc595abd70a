"""Headered CSV in a folder a player, for any number of players.

Spark's own writer makes a file in some 20 ms where the store sets rights and checksums by other programs, and
its driver moves the folders of a partitioned overwrite one after another. Here each task writes its
players' files through pyarrow and the moves are dealt over tasks too:

* rows are rebalanced by player, sorted by folder and written to files whose names end in ``.tmp``, which no
  reader takes; what the successful tasks wrote is a table of folders and names, written by Spark, so a task that
  is tried again leaves nothing but such a file;
* when all rows are there, a second job deletes what else lies in each folder of that table and
  takes ``.tmp`` off the new names. It may run again at any point.

Only the folders that get rows are replaced. Lines are made by ``to_csv``, Spark's own CSV.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.session import scratch_path
from courtside.stores import folder_tasks

CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Characters that Spark writes as %XX in a folder's name.
_ODD = "[\\x01-\\x1F\\x22#%'*/:=?\\x5C\\x7F{\\[\\]^]"


def _folder(name: str) -> Column:
    text = F.col(name).cast("string")
    safe = F.when(text.rlike(_ODD), F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike(_ODD), F.concat(F.lit("%"), F.hex(c))).otherwise(c)), "")).otherwise(text)
    return F.concat(F.lit(f"{name}="), F.when(text != "", safe).otherwise("__HIVE_DEFAULT_PARTITION__"))


def write_folders(df: DataFrame, path: str, place: str, parts: Sequence[str]) -> None:
    """Replace the folders ``<part>=<value>/...`` of the frame's rows under ``path`` (``place`` to pyarrow)."""
    spark = df.sparkSession
    names = [c for c in df.columns if c.lower() not in parts]
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"_{i}") for i, c in enumerate(names)]), CSV)).first()[0]
    key = uuid.uuid4().hex[:12]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(place)
        name, now, f = f"part-{key}-{uuid.uuid4().hex[:12]}.csv", None, None
        for batch in batches:
            runs, lines, done, at = pc.run_end_encode(batch.column(0)), batch.column(1), [], 0
            for folder, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if folder != now:
                    if f is not None:
                        f.close()
                        done.append(now)
                    store.create_dir(f"{base}/{folder}")
                    f, now = store.open_output_stream(f"{base}/{folder}/{name}.tmp"), folder
                    f.write(f"{header}\n".encode())
                f.write("\n".join([*lines[at:end].to_pylist(), ""]).encode())
                at = end
            yield pa.RecordBatch.from_pydict({"folder": pa.array(done, pa.string()), "name": pa.array([name] * len(done), pa.string())})
        if f is not None:
            f.close()
            yield pa.RecordBatch.from_pydict({"folder": [now], "name": [name]})

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(place)
        for batch in batches:
            for folder, new in zip(*(c.to_pylist() for c in batch.columns)):
                there = {i.base_name: i for i in store.get_file_info(FileSelector(f"{base}/{folder}"))}
                for n in there.keys() - {x + end for x in new for end in ("", ".tmp")}:
                    (store.delete_dir if there[n].type == FileType.Directory else store.delete_file)(there[n].path)
                for n in new:
                    if f"{n}.tmp" in there:
                        store.move(there[f"{n}.tmp"].path, f"{base}/{folder}/{n}")
            yield batch.select([0])

    lines = (df.hint("rebalance", F.col(parts[-1]))  # a few files a player, more for a player with much
             .select(F.concat_ws("/", *[_folder(p) for p in parts]).alias("_folder"), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), CSV).alias("_line"))
             .sortWithinPartitions("_folder"))
    listed = scratch_path(spark, "landed_files")
    lines.mapInArrow(write, "folder string, name string").write.parquet(listed)
    written = spark.read.schema("folder string, name string").parquet(listed)
    # dealt by number: the names' bytes alone would put all folders into one task
    new = written.repartition(folder_tasks(spark, written.count()), "folder").groupBy("folder").agg(F.collect_list("name").alias("names"))
    new.mapInArrow(settle, "folder string").write.format("noop").mode("overwrite").save()
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(found)  # without rows too
