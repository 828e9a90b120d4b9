"""Corpus pipeline: documents through the training-data operators.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that
is written as Parquet and reread as the next stage's documents.  All but
the last return the columns of ``documents``.

Defined cases, for every stage: each row is judged by itself, so null ids
and rows that repeat an id (with the same or another text) are neither
lost nor mixed up; a null or empty text is a text without words, which
``quality_rules`` rejects, no other stage drops but ``mixing`` (size 0 is
taken 0 times); texts are read whole; further columns pass through (the
last stage sets ``copies`` and ``taken``); an empty table gives an empty
one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierload.llm import decontam, mixture, neardup, pii, quality
from tierload.llm.common import save


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.apply_policy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity of 0.8 or more)."""
    return neardup.deduplicate(docs, q=5, percent=80, null_ids=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how many times (``copies``) and words (``taken``)."""
    return mixture.take(docs, (3, 1, 2), 1.5)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mixing", mixing)]

#: the seeded choice of the mix, and contextual extraction, are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
