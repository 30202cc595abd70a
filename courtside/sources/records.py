"""Records of delimited text files whose quoted fields may hold line breaks.

A line starts a record only if an even number of quotes stands before it in its file. That
number is found without any file passing through one task:

* ``part_facts`` scans the lines once and keeps a row per file part (the range of a file that a task
  reads): lines with an odd number of quotes, the first line, and what the folder names say;
* a running sum over the parts of a file says how many such lines stand before each part;
* a part in which every line is a record by itself (no odd line, an even number before it) is read
  as it is: no shuffle. Only the lines of other parts are numbered within their part; those of one
  record, which may begin in one part and end in a later one, are joined to one text;
* a small file that is read whole is one part: ``whole_facts`` finds the same beside its text, so
  ``whole_records`` needs no join to tell its header from its records.

The rows of ``part_facts`` are few (bytes / part size, and one a small file) and written before they
are used, so the planner knows their size when it joins them with the lines.

Quotes follow the rule of the landing files: a field with a quote, a separator or a line break stands in
quotes, and quotes inside are doubled. A header is one line. A quote that is never closed makes the
rest of the file one record.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.session import scratch_path

#: Folder names whose values belong to every row below them.
FOLDERS = ("season", "date", "player_id")


def file_lines(text: DataFrame) -> DataFrame:
    """``_path, _start, _row, _line`` of a text scan with line ends ``\\n`` only; ``_start`` is the
    part's place in the file, ``_row`` rises within a part."""
    return text.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
                       F.monotonically_increasing_id().alias("_row"), F.col("value").alias("_line"))


#: Files up to this size are read whole.
SMALL_BYTES = 4 << 20


def mixed_lines(files: DataFrame) -> DataFrame:
    """The same of any files, given as Spark's ``binaryFile`` rows: a small file is one part, opened once by a
    task that goes on to the next (a text scan sets up a reader a file, ten times the work); those above
    ``SMALL_BYTES``, of which there are few for the bytes they hold, are scanned in parts."""
    spark = files.sparkSession
    size = F.col("_metadata.file_size")  # known from the listing
    small = files.where(size <= SMALL_BYTES).select(
        F.col("_metadata.file_path").alias("_path"), F.lit(0).cast("bigint").alias("_start"),
        F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("_row", "_line"))
    small = small.withColumn("_row", F.col("_row").cast("bigint"))
    large = escaped(r[0] for r in files.where(size > SMALL_BYTES).select("path").collect())
    return file_lines(spark.read.option("lineSep", "\n").text(large)).unionByName(small) if large else small


def player_lines(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """Lines of the files in the players' own folders under date folders; None if there is none. The date folders
    are listed by Spark's tasks, so the driver asks the store for no player's folder."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(list(folders))
             .where(F.col("_metadata.file_path").rlike("/date=[^/]+/player_id=[^/]+/[^/]+$")))
    return mixed_lines(files) if files.select("path").take(1) else None  # take stops at the first file


def escaped(paths: Iterable[str]) -> list[str]:
    """Paths as patterns that match nothing else."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def _odd(line: Column) -> Column:
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.when(F.contains(line, F.lit('"')), quotes % 2).otherwise(0)


def _folder(name: str) -> Column:
    return F.try_url_decode(F.nullif(F.regexp_extract("_path", f"/{name}=([^/]+)/", 1), F.lit("")))


def _without_cr(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)


def _is_text(line: Column) -> Column:
    return F.trim(_without_cr(line)) != ""


def _header(line: Column) -> Column:
    return F.regexp_replace(line, "^﻿|\r$", "")


def _of_path() -> list[Column]:
    return [*[_folder(c).alias(f"_{c}") for c in FOLDERS], F.nullif(F.regexp_extract("_path", "/player_([0-9]+)\\.csv$", 1), F.lit("")).alias("_file_player")]


def part_facts(lines: DataFrame) -> DataFrame:
    """A row per file part: ``_path, _start, _odd`` (lines with an odd number of quotes), ``_before`` (such
    lines in earlier parts of the file), ``_lines`` (that aren't blank), ``_head`` and ``_head_row`` (the file's first line, on
    every part) and the values of the folder names. Written to the session's scratch folder."""
    line = F.col("_line")
    own = lines.groupBy("_path", "_start").agg(
        F.sum(_odd(line)).alias("_odd"), F.count_if(_is_text(line)).alias("_lines"), F.min("_row").alias("_first_row"),
        F.min_by(F.when(F.col("_start") == 0, line), F.col("_row")).alias("_first"))
    parts = Window.partitionBy("_path").orderBy("_start")
    from_start = parts.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    facts = own.select("_path", "_start", "_odd", "_lines",
                       F.coalesce(F.sum("_odd").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                       _header(F.first("_first").over(from_start)).alias("_head"), F.first("_first_row").over(from_start).alias("_head_row"), *_of_path())
    path = scratch_path(lines.sparkSession, "parts")
    facts.write.parquet(path)
    return lines.sparkSession.read.schema(facts.schema).parquet(path)


def whole_facts(files: DataFrame) -> DataFrame:
    """The facts of files that are one part, from ``_path`` and ``_text``; all columns of ``files`` stay beside them."""
    more = [c for c in files.columns if c != "_path"]
    lines = files.withColumn("_all", F.split("_text", "\n"))
    first = F.lit(0).cast("bigint")
    return lines.select("_path", first.alias("_start"), F.size(F.filter("_all", lambda x: _odd(x) == 1)).cast("bigint").alias("_odd"),
                        F.size(F.filter("_all", _is_text)).cast("bigint").alias("_lines"), first.alias("_before"),
                        _header(F.col("_all")[0]).alias("_head"), first.alias("_head_row"), *_of_path(), *more)


def whole_lines(whole: DataFrame) -> DataFrame:
    """``_path, _start, _row, _line`` of files with their ``_text``."""
    return (whole.select("_path", "_start", F.posexplode(F.split("_text", "\n")).alias("_row", "_line"))
            .withColumn("_row", F.col("_row").cast("bigint")))


def whole_records(whole: DataFrame) -> DataFrame:
    """``_record`` for every record but the header of files with their ``_text`` in which no line is odd; their
    other columns stay beside it."""
    more = [c for c in whole.columns if c != "_text"]
    return (whole.select(*more, F.explode(F.slice(F.split("_text", "\n"), 2, 1 << 30)).alias("_line"))  # from the second on
            .select(*more, _without_cr(F.col("_line")).alias("_record")).where(F.trim("_record") != ""))


def _is_broken() -> Column:
    """Whether a part holds lines that aren't records by themselves."""
    return (F.col("_odd") > 0) | (F.col("_before") % 2 == 1)


def records(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """``_path, _start, _record``: every record but the headers and blank ones, with its line breaks as they
    stand in the file. ``_start`` is the part in which the record begins."""
    at = facts.select(F.col("_path").alias("_p"), F.col("_start").alias("_s"), _is_broken().alias("_broken"), F.col("_before"), "_head_row")
    known = lines.join(at, (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s")))
    rows = known.where(~((F.col("_start") == 0) & (F.col("_row") == F.col("_head_row"))))
    whole = rows.where("NOT _broken").select("_path", "_start", F.col("_line").alias("_record"))
    if not facts.where(_is_broken()).isEmpty():
        # the number of odd lines before a line: of earlier parts, and within its own part
        earlier = Window.partitionBy("_path", "_start").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        numbered = (rows.where("_broken").select("_path", "_start", "_row", "_line", "_before", _odd(F.col("_line")).alias("_odd"))
                    .withColumn("_odds", F.col("_before") + F.coalesce(F.sum("_odd").over(earlier), F.lit(0))))
        alone = (F.col("_odds") % 2 == 0) & (F.col("_odd") == 0)
        # lines of one record: from the odd line that opens it to the one that closes it
        joined = (numbered.where(~alone).groupBy("_path", F.expr("_odds div 2").alias("_k"))
                  .agg(F.min("_start").alias("_start"), F.sort_array(F.collect_list(F.struct("_start", "_row", "_line"))).alias("_all"))
                  .select("_path", "_start", F.array_join(F.transform("_all", lambda x: x["_line"]), "\n").alias("_record")))
        whole = whole.unionByName(numbered.where(alone).select("_path", "_start", F.col("_line").alias("_record"))).unionByName(joined)
    return whole.withColumn("_record", _without_cr(F.col("_record"))).where(F.trim("_record") != "")


def counts(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """``_path, _start, n``: records that begin in each file part. Where every line is a record, the
    facts say so and the lines aren't read again."""
    if facts.where(_is_broken()).isEmpty():
        return facts.select("_path", "_start", (F.col("_lines") - F.when(F.col("_start") == 0, 1).otherwise(0)).alias("n")).where("n > 0")
    return records(lines, facts).groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("n"))


def fields(record: Column, width: int) -> Column:
    """The fields of a record as an array of ``width`` texts: doubled quotes are one quote, empty
    unquoted text is NULL, missing fields are NULL, further ones are left out."""
    schema = ", ".join(f"_{i} string" for i in range(width))
    parsed = F.from_csv(record, schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    return F.transform(F.array(parsed), lambda s: F.array(*[s[f"_{i}"] for i in range(width)]))[0]


def width(facts: DataFrame) -> int:
    """Fields of the widest header (commas inside quotes only make it wider than needed)."""
    commas = F.length("_head") - F.length(F.replace("_head", F.lit(","), F.lit("")))
    return 1 + (facts.agg(F.max(commas)).first()[0] or 0)
