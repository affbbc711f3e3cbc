"""The corpus pipeline: filter, deduplicate, decontaminate and mix ``documents``.

Every stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of ``documents``; the last one returns the mixture, one row per emitted
copy (column ``copy``, from 1).  Stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm import decontam, exact_dedup, mixing, quality_lm, simhash
from foldwise.llm.common import documents, materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity passes; the others go."""
    return quality_lm.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for every distinct text, the one with the largest doc_id."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says."""
    return mixing.mix(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", decontaminate), ("source mix", mixture)]

ORACLE_SQL = None  # the classifier's model is not expressible in SQL; tests/llm compares with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
