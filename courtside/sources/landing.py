"""Landed CSV snapshots: ``<root>/<dataset>/season=S/date=D/*.csv``.

Shot files also come one per player, either as ``player_<id>.csv`` under
the date folder or, as our writer lands them, under ``player_id=<id>/``.

Two traps decide how files are read:

* an explicit schema binds CSV columns **by position**, so a file whose
  header says ``L,W`` would silently swap wins and losses;
* one scan over files with different headers applies one file's header
  to all of them.

So rows are read as text and bound by name to the first line of their
own file, in one plan for any number of files and header versions.
``courtside.sources.records`` finds the records (a quoted field may hold
line breaks) and each file's header in one pass that leaves a small table, a row
per file part; the rows are then read once and look up their header there.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.schemas import PLAYER_COLUMNS, SHOT_COLUMNS, STANDINGS_COLUMNS
from courtside.sources.player_files import landed_files
from courtside.sources.records import escaped, fields, file_lines, part_facts, records, whole_records, width


def resolve_columns(df: DataFrame, targets: Mapping[str, Sequence[str]],
                    keep: Iterable[str] = (), optional: Iterable[str] = ()) -> DataFrame:
    """Select ``{target: [candidates]}`` by name, case-insensitively; the first
    candidate present wins. A target missing from the frame raises a
    KeyError naming its candidates and the columns available, unless it is
    listed in ``optional`` (then it is left out). Columns named in ``keep``
    pass through when present.
    """
    by_lower = {}
    for c in df.columns:
        by_lower.setdefault(c.lower(), c)
    optional = set(optional)
    cols, used = [], set()
    for target, candidates in targets.items():
        found = next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)
        if found is None:
            if target in optional:
                continue
            raise KeyError(f"no column for {target!r}: any of {list(candidates)} would do, "
                           f"the frame has {list(df.columns)}")
        cols.append(F.col(f"`{found}`").alias(target))
        used.add(target)
    for k in keep:
        if k.lower() in by_lower and k not in used:
            cols.append(F.col(f"`{by_lower[k.lower()]}`").alias(k))
    return df.select(*cols)


def tracked_players(df: DataFrame, ids: Sequence[int] | DataFrame, column: str = "player_id") -> DataFrame:
    """Rows of the tracked players: a left-semi join with the list, which the
    planner broadcasts or shuffles by its size. A list kept as a table (its first column) never passes
    the driver; if it is a filtered table too large to broadcast, the planner builds a Bloom filter of its ids
    and drops other players' rows before they are shuffled. NULL ids are nobody's."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).cast("bigint").alias("_tracked"))
    else:
        wanted = df.sparkSession.createDataFrame([(int(i),) for i in dict.fromkeys(ids)], "_tracked bigint")
    return df.join(wanted, F.col(column) == F.col("_tracked"), "left_semi")


def _lines(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    return file_lines(spark.read.option("lineSep", "\n").text(list(patterns)))


def _if_there(spark: SparkSession, patterns: Sequence[str]) -> DataFrame | None:
    """Lines of all files that match; None if no file does."""
    try:
        return _lines(spark, patterns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def bind_by_header(lines: DataFrame, facts: DataFrame, targets: Mapping[str, Sequence[str]], optional: Iterable[str] = ()) -> DataFrame:
    """Records of landed files with the target columns as text, ``season``, ``date`` and the player that the
    path names.

    A file's header is its first line, whatever it says; a later line that says the same is data. Each
    record is bound to its own file's header by name, so any number of header versions goes
    through one plan; names nobody asked for are ignored, and a file
    without any candidate of a required target raises an error that names
    its candidates and header. No file is ever left out.
    """
    n = width(facts)
    bound = _places(facts, n, targets, optional).select(F.col("_path").alias("_p"), F.col("_start").alias("_s"), "_at", "_path_season", "date", "_player_id")
    return _bound(records(lines, facts).join(bound, (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s"))), n, targets)


def bind_whole(whole: DataFrame, targets: Mapping[str, Sequence[str]], optional: Iterable[str] = ()) -> DataFrame:
    """The same for files with their ``_text`` in which no line is odd: each is bound by its own row, without a join."""
    n = width(whole)
    return _bound(whole_records(_places(whole, n, targets, optional, "_text")), n, targets)


def _places(facts: DataFrame, n: int, targets: Mapping[str, Sequence[str]], optional: Iterable[str], *more: str) -> DataFrame:
    """Of each file part whose file has a header: where the targets stand in it (``_at``), and what the path names."""
    optional = set(optional)
    heads = facts.where("_head IS NOT NULL").withColumn("_names", F.transform(fields(F.col("_head"), n), lambda t: F.lower(F.trim(t))))
    at = []
    for target, candidates in targets.items():
        places = [F.array_position("_names", c.lower()) for c in candidates]
        first = F.coalesce(*[F.when(p > 0, p) for p in places])
        if target not in optional:
            said = F.concat(F.lit(f"No column for {target!r} (any of {list(candidates)}) in the header "), F.col("_head"), F.lit(" of "), F.col("_path"))
            first = F.coalesce(first, F.raise_error(said).cast("bigint"))
        at.append(first.cast("int").alias(f"_{target}"))
    season = F.array_position("_names", "season")
    return heads.select("_path", "_start", F.struct(*at, F.when(season > 0, season).cast("int").alias("_season")).alias("_at"),
                        F.col("_season").alias("_path_season"), F.col("_date").cast("date").alias("date"), "_player_id", *more)


def _bound(rows: DataFrame, n: int, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = rows.withColumn("_field", fields(F.col("_record"), n))
    def field(name: str) -> Column:
        return F.get("_field", F.col(f"_at.{name}") - 1)
    cols = [field(f"_{t}").alias(t) for t in targets]
    return rows.select(*cols, F.coalesce("_path_season", field("_season")).alias("season"), "date", "_player_id")


def landing_targets(dataset: str) -> tuple[dict, set]:
    """Canonical name -> candidate header names, and the optional targets."""
    if dataset == "player_stats":
        return dict(PLAYER_COLUMNS, fga=["fga", "FGA"], fta=["fta", "FTA"]), {"fga", "fta"}
    if dataset == "team_standings":
        return dict(STANDINGS_COLUMNS), set()
    if dataset == "shot_charts":
        return {c: [c] for c in SHOT_COLUMNS}, set()
    raise KeyError(f"unknown dataset {dataset!r}")


def landed_dates(spark: SparkSession, base: str, season: str | None) -> dict[str, list[str]]:
    """Date folders of each season folder, rising, from folder names alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/season={season or '*'}/date=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    dates: dict[str, list[str]] = {}
    for status in found or []:
        date = status.getPath()
        dates.setdefault(date.getParent().getName(), []).append(date.getName())
    return {s: sorted(d) for s, d in sorted(dates.items())}


def newest_dates(spark: SparkSession, base: str, season: str | None) -> list[str]:
    """Folder patterns of each season's newest date."""
    return [f"{base}/{s}/{d[-1]}" for s, d in landed_dates(spark, base, season).items()]


def read_landing(spark: SparkSession, root: str, dataset: str, season: str | None = None,
                 date: str | None = None, newest_only: bool = False) -> DataFrame:
    """Landed rows of one dataset as strings under canonical names, plus the
    partition columns ``season`` and ``date``.

    Columns are bound by name per file (candidate names, case-insensitive,
    see ``courtside.schemas``), so ``WINS`` in one file and ``W`` in another
    both become ``wins``. ``newest_only`` reads each season's newest date
    folder and nothing else. A pass over the files for quotes and headers runs at once, and small files in players' own
    folders are copied to the scratch folder; the rows are read when they are used. A player's shots that were landed on one date
    both in the date folder and in a folder of the player's own count once
    (the date folder's).
    """
    base = f"{root.rstrip('/')}/{dataset}"
    folders = newest_dates(spark, base, season) if newest_only else [f"{base}/season={season or '*'}/date={date or '*'}"]
    targets, optional = landing_targets(dataset)
    own = landed_files(spark, folders) if folders and dataset == "shot_charts" else None
    # where few files lie beside players' folders they are named: a pattern would make the driver look at each folder
    files = [f"{f}/*.csv" for f in folders] if own is None or own.beside is None else escaped(own.beside)
    bulk = _if_there(spark, files) if files else None
    if bulk is None and (own is None or not own.there):
        raise FileNotFoundError(f"no landed {dataset} files under {folders or base}")
    out = days = None
    if bulk is not None:
        facts = part_facts(bulk)
        days = facts.select("_season", "_date").distinct()
        out = bind_by_header(bulk, facts, targets, optional).drop("_player_id")
    if own is not None and own.there:
        # the folder's name is the player where the file doesn't say
        optional = {*optional, "player_id"}
        single = [bind_whole(own.alone, targets, optional)] if own.alone is not None else []
        single += [bind_by_header(own.lines, own.facts, targets, optional)] if own.lines is not None else []
        single = reduce(DataFrame.unionByName, single).withColumn("player_id", F.coalesce("player_id", "_player_id")).drop("_player_id")
        if out is not None and not own.days().join(days, ["_season", "_date"], "left_semi").isEmpty():
            there = out.select(F.col("season").alias("_s"), F.col("date").alias("_d"), F.col("player_id").alias("_p")).distinct()
            single = single.join(there, F.col("season").eqNullSafe(F.col("_s")) & F.col("date").eqNullSafe(F.col("_d"))
                                 & F.col("player_id").eqNullSafe(F.col("_p")), "left_anti")
        out = single if out is None else out.unionByName(single)
    return out
