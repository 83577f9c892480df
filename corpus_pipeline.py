"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage takes the documents that its predecessor kept and calls one operator; its result is
written as Parquet and read again as the documents of the next. All but the last return the
columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from procurelens.llm.common import saved, table
from procurelens.llm.exact_dedup import drop_copies
from procurelens.llm.mixing import mixed_documents
from procurelens.llm.packing import pack_documents
from procurelens.llm.simhash import drop_near_copies
from procurelens.llm.toxicity import clean_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it learns from the training folds of ``labels``."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_copies(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a component of near copies the document with the smallest id stays."""
    return drop_near_copies(spark, docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one copy per source is cut where its quota ends."""
    return mixed_documents(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of fixed length."""
    return pack_documents(spark, docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: A trained classifier, components and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
