"""Corpus pipeline: toxicity, near-duplicates, secrets, mixing, tokenising.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows its
predecessor kept; between stages the rows are written as Parquet and read
again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyframe.llm import bpe_words, pivotal_mix, secret_scan, simhash_pigeonring, toxicity_knn
from skyframe.llm.common import ready
from skyframe.session import checkpoint_dir, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    ready(spark)
    return toxicity_knn.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    ready(spark)
    return simhash_pigeonring.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    return secret_scan.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped so that sources meet their targets."""
    return pivotal_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and of the text decoded from them."""
    ready(spark)
    return bpe_words.digests(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing),
          ("tokens", tokens)]

# Drawn copies and byte-pair ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
