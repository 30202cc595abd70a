"""Mixing sources to target weights with hash thresholds.

Every source gets a target: its weight's share of all words, at most ``cap`` times its own words,
the excess reshared by weight. A source's documents are taken ``floor(target / size)`` times as a
whole, and once more those whose hash is below the source's threshold. So the sets for one, two
and three copies are nested. The threshold is found from histograms: words by source and the
top 12 bits of the hash, then of the one bucket where the budget is crossed words by the next 12
bits, and so on to the last bit. Documents are never sorted; each refinement reads only rows of
the boundary buckets, and its histogram has at most 4096 rows a source.

Defined cases: null text has size 0 and is taken 0 times its words; a null source is a source of
its own (last in order), a null id hashes as the empty text. Rows with equal ids share a hash and are
taken together; the hash at the budget is taken if half its words or more fit. Sources without
words have target 0. An empty table gives an empty result. Reruns agree.

Per-source totals pass through one window without partitions: the only table that does, with a row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import cut, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
HASH_BITS, LEVEL_BITS = 60, 12


def hash60(id_col: Column) -> Column:
    """First 60 bits of the MD5 of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) plus target, whole copies ``base`` and the words left for one more copy, ``budget``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w.cast("long")).withColumn("most", F.col("source_size") * cap)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("most").cast("double") / F.col("w"), F.col("source").asc_nulls_last())
    rows = (rows.withColumn("before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("after", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("rate", (F.sum("source_size").over(everything) - F.col("before")).cast("double") / F.col("after").cast("double")))
    # the first source in this order that its share doesn't fill sets the rate for the rest
    open_rate = F.max(F.when(F.col("most").cast("double") / F.col("w") > F.col("rate"), F.col("rate"))).over(everything)
    target = F.least(F.col("most").cast("double"), F.col("w") * F.coalesce(open_rate, F.lit(0.0)))
    return (rows.withColumn("target", target)
            .withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
            .select("source", "source_size", "target", "base", "budget"))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, limit): documents of a source with a hash below ``limit`` make up its budget."""
    state = goals.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("passed"))
    for level in range(HASH_BITS // LEVEL_BITS):
        low = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = sized.select(F.col("source").alias("s"), "size", F.shiftright("hash", low).alias("bucket"))
        here = inside.join(state, F.col("s").eqNullSafe(F.col("source")) & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")))
        bars = here.groupBy("source", "bucket", "budget", "passed").agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("source").orderBy("bucket")
        bars = bars.withColumn("end", F.col("passed") + F.sum("words").over(upto))
        if low:  # the first bucket that goes beyond the budget is the only one to look into
            state = (bars.filter(F.col("end") > F.col("budget")).groupBy("source", "budget")
                     .agg(F.min_by(F.struct("bucket", (F.col("end") - F.col("words")).alias("passed")), "bucket").alias("x"))
                     .select("source", "budget", F.col("x.bucket").alias("prefix"), F.col("x.passed").alias("passed")))
        else:
            fits = F.col("end") - F.col("words") + F.col("words") / F.lit(2.0) <= F.col("budget")
            state = bars.groupBy("source").agg(F.coalesce(F.max(F.when(fits, F.col("bucket") + 1)), F.min("bucket")).alias("limit"))
    return state


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies and taken words."""
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), hash60(F.col(id_col)).alias("hash")))
    goals = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap))
    limits = thresholds(sized, goals)
    plan = cut(goals.alias("g").join(limits.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")), "left")
               .select(F.col("g.source").alias("of"), "source_size", "target", "base", F.coalesce("limit", F.lit(0)).alias("limit")))
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    copies = F.col("base") + (F.col("hash") < F.col("limit")).cast("long")
    return rows.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
rates AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS most,
         CAST((SELECT sum(source_size) FROM totals)
              - coalesce(sum(3 * source_size) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(w) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM totals),
goals AS (
  SELECT source, source_size, least(most, w * coalesce((SELECT max(rate) FROM rates WHERE most / w > rate), 0.0)) AS target FROM rates),
based AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM goals),
ranked AS (
  SELECT s.doc_id, s.source, s.size, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS own
  FROM sized s JOIN based b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       CAST(base + CASE WHEN upto - own + own / 2.0 <= budget THEN 1 ELSE 0 END AS BIGINT) AS copies,
       CAST(size * (base + CASE WHEN upto - own + own / 2.0 <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
"""
