"""The corpus pipeline: documents through five operators, each stage on all that the one before
kept. A stage is a function of (spark, docs, sf_dir); its result is written as Parquet to the
shared folder and read again as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanmill.llm import (bin_completion, quality_rules, simhash_dedup, toxicity_cnn, weak_pii)
from spanmill.llm.common import table, written
from spanmill.llm.queries import pieces_with_crc


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic."""
    return toxicity_cnn.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return simhash_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return weak_pii.masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per token piece with its sequence and place."""
    return pieces_with_crc(bin_completion.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packing)]

#: Training, components and packing are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
