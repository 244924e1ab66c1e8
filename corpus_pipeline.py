"""A training corpus from raw documents: filter, deduplicate, decontaminate, redact, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to
the shared folder and rereads it as the next stage's documents. All but the last stage return
the columns of ``documents``; the last returns the training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import leaks, mixing, neardup, secrets, toxicity
from touchline.llm.common import prepare, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger scores below its cut."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.reject(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8)."""
    prepare(spark)
    return neardup.dedupe(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder."""
    prepare(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: taken copies of documents by position."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # learned scores and latent search are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
