"""Stores as pyarrow names them, for tasks that write, list or read many small files."""

from __future__ import annotations

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import SparkSession


def store_uri(spark: SparkSession, path: str) -> str | None:
    """The path with its store's name as pyarrow reads it; None if pyarrow doesn't open that store."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toUri().toString()
    scheme, rest = uri.split(":", 1)
    place = uri if rest.startswith("//") else f"{scheme}://{rest}"
    try:
        FileSystem.from_uri(place)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return place


#: Folders that one task lists, reads or settles; tasks at most.
FOLDERS_A_TASK, MOST_TASKS = 2000, 100_000


def folder_tasks(spark: SparkSession, folders: int) -> int:
    """Tasks for so many folders: a folder's name is a few bytes, its files are slow to reach."""
    return max(1, min(folders, max(spark.sparkContext.defaultParallelism, -(-folders // FOLDERS_A_TASK)), MOST_TASKS))
