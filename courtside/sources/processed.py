"""Processed tables: catalog registration and reads.

One ``database`` setting (default ``processed``) names where the tables
live; queries resolve tables through the session catalog or a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_DATABASE = "processed"


def _ident(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def register_table(spark: SparkSession, name: str, path: str,
                   database: str = DEFAULT_DATABASE, partitioned: bool = True) -> str:
    """Create the database and a Parquet table over ``path`` if missing, add
    columns that the files have gained since, and pick up partitions
    (seasons) added since: ``MSCK REPAIR TABLE`` for a partitioned table,
    ``REFRESH TABLE`` for changed files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    full = _ident(database, name)
    loc = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet "
              f"OPTIONS (mergeSchema 'true') LOCATION '{loc}'")
    files = spark.read.option("mergeSchema", "true").parquet(path).schema
    known = {c.lower() for c in spark.table(full).columns}
    new = [f for f in files.fields if f.name.lower() not in known]
    if new:
        added = ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({added})")
    if partitioned and spark.catalog.listColumns(f"{database}.{name}") and any(
            c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
        spark.sql(f"MSCK REPAIR TABLE {full}")
    spark.sql(f"REFRESH TABLE {full}")
    return f"{database}.{name}"


def read_processed(spark: SparkSession, name: str, database: str = DEFAULT_DATABASE,
                   path: str | None = None) -> DataFrame:
    """A processed table from the catalog, or straight from its Parquet path
    (partition discovery gives ``season``; filters on it prune folders). A path that
    ``courtside.sinks.publish`` writes gives its newest complete version."""
    if path is not None:
        from courtside.sinks.publish import is_published, read_published

        if is_published(spark, path):
            return read_published(spark, path)
        df = spark.read.option("mergeSchema", "true").parquet(path)
        # '1998' is a season's name, whatever folder names look like
        return df.withColumn("season", F.col("season").cast("string")) if "season" in df.columns else df
    return spark.table(_ident(database, name))
