"""Publishing processed seasons: versioned folders and one catalog switch.

A run writes the seasons it changed to a version folder of their own, then a manifest that names for
every season the folder that holds it (changed ones the new folder, others the one they had),
and last replaces the table's view in the catalog. The view is the only thing that readers
resolve, and replacing it is one catalog operation: a reader sees all of the old state or all of the new
one, whatever the number of seasons. A run that fails before the switch leaves the old state; what it
wrote is not referenced by anything and goes with ``expire_versions``.

    <table>/versions/<n>-<id>/season=S/...     rows, never changed once written
    <table>/_manifests/version=<n>/...         season, folder, columns

A new version starts from the one that the catalog shows, so nothing of a failed run comes in later.
Readers by path take the newest complete manifest. Columns that only some seasons have are NULL in
the others. One writer a table is assumed; a second one at the same time fails on the manifest's folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.sinks.files import write_processed
from courtside.sources.processed import DEFAULT_DATABASE, _ident

MANIFEST = "season string, folder string, columns string"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    at, fs = _folder(spark, pattern)
    return sorted(int(s.getPath().toString().rsplit("version=", 1)[1].split("/")[0]) for s in fs.globStatus(at) or [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's complete manifests, rising."""
    return _numbers(spark, f"{path.rstrip('/')}/_manifests/version=*/_SUCCESS")


def current(spark: SparkSession, name: str, path: str, database: str = DEFAULT_DATABASE) -> int | None:
    """The version that the catalog's view shows; without a view, the newest complete one, if any."""
    if spark.catalog.tableExists(f"{_ident(database)}.{_ident(name)}"):
        shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(database, name)}").collect()}
        return int(shown["version"])
    return max(versions(spark, path), default=None)


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``season, folder, columns`` of a version, the newest by default; empty before the first."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/_manifests/version={known[-1] if version is None else version}")


def _columns(rows) -> dict[str, str]:
    """All columns of a manifest's seasons with their types, in the order in which they came."""
    out: dict[str, str] = {}
    for r in rows:
        for c in r["columns"].split("\n"):
            name, kind = c.split("\t")
            out[name] = kind
    return out


def _season_sql(row, columns: dict[str, str]) -> str:
    has = {c.split("\t")[0] for c in row["columns"].split("\n")}
    cols = [f"CAST({_ident(c) if c in has else 'NULL'} AS {kind}) AS {_ident(c)}" for c, kind in columns.items()]
    season = "CAST(NULL AS STRING)" if row["season"] is None else "'" + row["season"].replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"SELECT {', '.join(cols)}, {season} AS season FROM parquet.{_ident(row['folder'])}"


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its newest complete manifest, or of the given version."""
    rows = sorted(manifest(spark, path, version).collect(), key=lambda r: r["season"] or "")  # a row a season
    columns = _columns(rows)
    return reduce(DataFrame.unionByName, [spark.sql(_season_sql(r, columns)) for r in rows])


def write_version(df: DataFrame, path: str, base: int | None, cluster_by: Sequence[str] = ()) -> int:
    """Write the seasons in ``df`` as a new version next to the ones there are and add a manifest of
    them and the other seasons of version ``base``; returns its number. Nothing that readers of earlier
    versions use is touched."""
    spark = df.sparkSession
    number = max(_numbers(spark, f"{path.rstrip('/')}/_manifests/version=*"), default=0) + 1
    place = f"{path.rstrip('/')}/versions/{number}-{uuid.uuid4().hex[:8]}"
    write_processed(df, place, cluster_by=cluster_by)
    columns = "\n".join(f"{f.name}\t{f.dataType.simpleString()}" for f in df.schema.fields if f.name != "season")
    pattern, fs = _folder(spark, f"{place}/season=*")
    written = [s.getPath() for s in fs.globStatus(pattern) or []]  # a folder a season
    names = spark.createDataFrame([(p.getName()[len("season="):], p.toString()) for p in written], "name string, folder string")
    fresh = names.select(F.try_url_decode(F.nullif("name", F.lit("__HIVE_DEFAULT_PARTITION__"))).alias("season"), "folder", F.lit(columns).alias("columns"))
    earlier = spark.createDataFrame([], MANIFEST) if base is None else manifest(spark, path, base)
    kept = earlier.join(fresh.select(F.col("season").alias("_s")), F.col("season").eqNullSafe(F.col("_s")), "left_anti")
    fresh.unionByName(kept).coalesce(1).write.mode("error").parquet(f"{path.rstrip('/')}/_manifests/version={number}")
    return number


def switch(spark: SparkSession, name: str, path: str, version: int, database: str = DEFAULT_DATABASE) -> None:
    """Point the catalog's view at a version: one statement, the only step that readers notice."""
    rows = sorted(manifest(spark, path, version).collect(), key=lambda r: r["season"] or "")
    columns = _columns(rows)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    body = " UNION ALL ".join(_season_sql(r, columns) for r in rows)
    spark.sql(f"CREATE OR REPLACE VIEW {_ident(database, name)} TBLPROPERTIES ('version' = '{version}') AS {body}")


def publish(df: DataFrame, name: str, path: str, database: str = DEFAULT_DATABASE, cluster_by: Sequence[str] = ()) -> int:
    """Write ``df``'s seasons as a new version and switch the catalog to it; returns its number."""
    base = current(df.sparkSession, name, path, database)
    if df.isEmpty():
        return base or 0
    number = write_version(df, path, base, cluster_by)
    switch(df.sparkSession, name, path, number, database)
    return number


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete manifests but the newest ``keep`` and version folders that none of those names (left by
    replaced seasons and failed runs); returns the folders deleted. Run it when no reader still uses them."""
    known = versions(spark, path)
    used = {r["folder"].rsplit("/", 2)[-2] for v in known[-keep:] for r in manifest(spark, path, v).collect()}
    gone = []
    pattern, fs = _folder(spark, f"{path.rstrip('/')}/versions/*")
    for s in fs.globStatus(pattern) or []:
        if s.getPath().getName() not in used:
            gone.append(s.getPath().toString())
            fs.delete(s.getPath(), True)
    for v in known[:-keep]:
        fs.delete(_folder(spark, f"{path.rstrip('/')}/_manifests/version={v}")[0], True)
    return sorted(gone)
