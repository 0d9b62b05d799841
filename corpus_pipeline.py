"""Corpus pipeline: language ID, near-duplicates, secrets, source mix, tokens.

Every stage works on all rows that the one before kept, from Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.llm import language, minhash, mixing, secret_scan, sentencepiece
from captrail.llm.common import remove, shared_dir
from captrail.session import ship


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: text without a letter, or that no mixture of the learned languages explains, goes."""
    ship(spark)
    return language.kept_languages(docs, language.calibrated(docs, language.fit(docs)))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    ship(spark)
    return minhash.one_of_each(docs, shingle=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking credentials are replaced and n_chars follows the text."""
    ship(spark)
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source mix takes, once for each lap in which it takes words of them."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document that is left."""
    ship(spark)
    return sentencepiece.encode(docs, sentencepiece.load())


STAGES = [("language_id", identify), ("near_duplicates", deduplicate), ("secrets", hide_secrets), ("mixing", mix), ("tokens", tokenize)]
#: The stages hold trained models, hashes and regular expressions that DuckDB lacks; tests/llm/test_pipeline.py compares each
#: stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's table is dropped when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
