"""The registered queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import (
    brown_lm, decontam, html_main, langid, licences, merkle, mixing, packing, quality_knn, quality_rules, simhash, toxicity, whitening,
)
from courtside.llm.common import id_bucket, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", id_bucket("doc_id").alias("fold"))
    model = langid.train(docs.filter("fold <> 0 and lang is not null"))
    found = langid.predict(docs.select("doc_id", "text", "fold"), model)
    return found.select("doc_id", F.expr("fold = 0").alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", id_bucket("doc_id").alias("fold"))
    labels = table(spark, sf_dir, "labels").filter(id_bucket("doc_id") != 0)
    model = quality_knn.train(docs.filter("fold <> 0"), labels, "doc_id", "text", "quality", docs.select("text"))
    found = quality_knn.score(docs, model)
    return found.select("doc_id", F.expr("fold = 0").alias("held_out"), "score", F.expr("cast(score >= 0.3 as int)").alias("predicted"))


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (id_bucket("doc_id") == 1).alias("held_out"), "text")
    model, words = brown_lm.train(docs.filter("not held_out").select("text"))
    return brown_lm.score(docs, model, words)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", id_bucket("doc_id").alias("fold"))
    labels = table(spark, sf_dir, "labels").filter(id_bucket("doc_id") != 0)
    model = toxicity.train(docs.filter("fold <> 0"), labels, "doc_id", "text", "toxic")
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.expr("fold = 0").alias("held_out"), "score", F.expr("cast(score >= 0.5 as int)").alias("predicted"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.prove(merkle.build(table(spark, sf_dir, "documents"))))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.read_vocabulary())


QUERIES = {"op1_simhash": op1_simhash, "op2_quality": op2_quality, "op3_decontam": op3_decontam, "op4_langid": op4_langid, "op5_mixing": op5_mixing, "op6_quality_knn": op6_quality_knn, "op7_brown_lm": op7_brown_lm, "op8_html": op8_html, "op9_toxicity": op9_toxicity, "op10_licences": op10_licences,
           "op11_whitening": op11_whitening, "op12_merkle": op12_merkle, "op13_packing": op13_packing}
ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op10_licences": licences.oracle(), "op12_merkle": merkle.oracle()}
