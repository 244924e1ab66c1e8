"""Registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    alignment, chat, codes, langid, leaks, licenses, mixing, neardup, phrases, secrets, tokens, toxicity, wrappers,
)
from touchline.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.assign(table(spark, sf_dir, "documents"))
    first = F.get("copies", F.lit(0))["position"]
    return (
        rows.withColumn("first_position", F.round(first, 9))
        .withColumn("n_copies", F.size("copies").cast("long"))
        .drop("copies")
        .orderBy(F.asc_nulls_last("first_position"), "doc_id")
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{ours}'), (-1L, 1L, 'assistant', '{ours}') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.render(chat.fold(chat.events_of(rows))))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count(table(spark, sf_dir, "documents"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.neighbours(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(table(spark, sf_dir, "embeddings"))


def op13_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_mixing": op2_mixing,
    "op3_licenses": op3_licenses,
    "op4_chat": op4_chat,
    "op5_leaks": op5_leaks,
    "op6_tokens": op6_tokens,
    "op7_neardup": op7_neardup,
    "op8_langid": op8_langid,
    "op9_toxicity": op9_toxicity,
    "op10_phrases": op10_phrases,
    "op11_alignment": op11_alignment,
    "op12_codes": op12_codes,
    "op13_wrappers": op13_wrappers,
}
