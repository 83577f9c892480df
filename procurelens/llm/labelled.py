"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of the training folds; rows that repeat an id are averaged and rounded."""
    rows = labels.select("doc_id", F.col(label).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    rows = rows.where(fold("doc_id", folds) != held_out)
    return rows.groupBy("doc_id").agg(F.round(F.avg("label")).cast("int").alias("label"))


def smallest_hashes(rows: DataFrame, most: int) -> DataFrame:
    """``most`` rows at most, those with the smallest hash of their id: a sample that reruns repeat."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def texts_of(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, ...) of a bounded sample of ids, which is broadcast."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")

