"""From raw documents to packed bins: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packtrace.llm import exact, langid, packing, simhash, toxicity
from packtrace.llm.common import table
from packtrace.session import durable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from ``labels``, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents show."""
    return langid.drop_unknown(docs, langid.learnable(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest and then the smallest id."""
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal fingerprints, the one with the smallest id."""
    return simhash.drop_near(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in bins."""
    return packing.pack(docs).select("doc_id", "piece", "start", "length", "bin_id", "offset")


STAGES = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

# models and fingerprints are beyond SQL: tests/llm compares the stages with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
