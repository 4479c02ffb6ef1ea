"""The training-data pipeline: score, deduplicate, deduplicate nearly, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meseta.llm import exact_dedup, mixing, near_dedup, packing, quality_model
from meseta.llm.common import stage
from meseta.llm.registry import table
from meseta.session import scratch_path


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality_model.good_documents(docs, table(spark, sf_dir, "labels"))


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, that with the largest id."""
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return exact_dedup.drop_copies(docs, index)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.repeat_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", unique_texts),
    ("near dedup", unlike_texts),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# The classifier and the random draws of the mix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each writes its result and the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{number + 1}")
    return docs
