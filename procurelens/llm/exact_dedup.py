"""Exact duplicates with a split for heavy hitters.

Every partition keeps a Misra-Gries summary of its digests. The summaries are added up, which
leaves at most ``counters`` digests that can own more than ``2 / counters`` of the rows. One
pass counts these exactly and finds their winner; the verified winners, at most ``counters``
rows, are broadcast, and their copies are settled on the map side without a shuffle. All other
digests are rare by then and go through an ordinary shuffle.

Defined cases: a null text counts as empty; of equal texts the row with the largest id stays,
ids that are null count as smallest; rows that repeat both text and id share their group's
answer in ``exact_groups`` and leave one row in ``drop_copies``; an empty table gives an
empty result; other columns, whatever their names, pass through ``drop_copies`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procurelens.llm.common import fresh, saved, table, tidy

#: Counters of a Misra-Gries summary; bounds the broadcast winners.
COUNTERS = 1000


def text_digest(column: str):
    return F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")), 256)


def reduce_summary(counts: pd.Series, counters: int) -> pd.Series:
    """Misra-Gries reduction: subtract the first count that no longer fits, keep what is positive."""
    if len(counts) <= counters:
        return counts
    counts = counts - counts.nlargest(counters + 1).iloc[-1]
    return counts[counts > 0]


def _summaries(counters: int):
    @tidy
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.Series(dtype="int64")
        for batch in batches:
            kept = kept.add(batch["digest"].value_counts(), fill_value=0).astype("int64")
            kept = reduce_summary(kept, counters)
        yield pd.DataFrame({"digest": kept.index.astype(str), "hits": kept.to_numpy()})

    return summarise


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of the frequent digests, counted exactly: ``counters`` rows at most."""
    rows = digests.count()
    found = digests.select("digest").mapInPandas(_summaries(counters), "digest string, hits long")
    floor = rows / (counters + 1)
    candidates = found.groupBy("digest").agg(F.sum("hits").alias("hits")).where(F.col("hits") > floor)
    counted = digests.join(F.broadcast(candidates.select("digest")), "digest").groupBy("digest")
    return counted.agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")).where(
        F.col("group_size") > floor
    )


def exact_groups(spark: SparkSession, digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(id, digest, keep_id, group_size) for each row of a written table (id, digest)."""
    winners = saved(spark, heavy_winners(digests, counters), "winners")
    heavy = digests.join(F.broadcast(winners), "digest")
    light = digests.join(F.broadcast(winners), "digest", "left_anti")
    same = W.partitionBy("digest")
    light = light.withColumn("keep_id", F.max("id").over(same)).withColumn("group_size", F.count("*").over(same))
    return heavy.select("id", "digest", "keep_id", "group_size").unionByName(light)


def document_digests(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return saved(spark, docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest")), "digests")


def drop_copies(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """The documents without exact copies; frequent copies never enter the shuffle."""
    winners = saved(spark, heavy_winners(document_digests(spark, docs, id_col, text_col), counters), "winners")
    digest, keep, rank = fresh(docs, "_digest"), fresh(docs, "_keep"), fresh(docs, "_rank")
    winners = winners.select(F.col("digest").alias(digest), F.struct("keep_id").alias(keep))
    marked = docs.withColumn(digest, text_digest(text_col)).join(F.broadcast(winners), digest, "left")
    lost = F.col(keep).isNotNull() & ~F.col(id_col).eqNullSafe(F.col(f"{keep}.keep_id"))
    first = W.partitionBy(digest).orderBy(F.col(id_col).desc_nulls_last())
    return marked.where(~lost).withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).select(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(spark, document_digests(spark, table(spark, sf_dir, "documents")))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
