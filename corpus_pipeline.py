"""Corpus pipeline: language ID, quality rules, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of ``documents``; the last returns the mix: a row per kept document with the
words to take from it. ``run`` writes every stage's result to the session's shared folder and
reads it again, so a stage is computed once and survives lost executors.

Rejected: texts without a known language; texts that fail the base rules or their script's
fertility bands; all but the smallest id of each near-duplicate group; texts with a benchmark item.
An empty table gives an empty result. Null and empty texts go with the first stage; null ids, languages and
sources stay as they are. Repeated rows and exact copies are one group to near-dedup: the row with the
smallest id stays, and of equal ids one. Texts are used whole, however long. Other columns pass through the
first four stages whatever their names; the mix's own columns take the place of equal-named ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtside.llm import decontam, langid, mixing, quality_rules, simhash
from courtside.llm.common import table
from courtside.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("language_id", known_language), ("quality_rules", good_quality), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("mixing", mix_sources)]

#: Language ID, fertility, SimHash components and latent retrieval can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
