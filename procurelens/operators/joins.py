"""Join helpers for hot keys."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 4
#: A key with more than this share of the rows is hot, and no part of it holds more than that.
HOT_SHARE = 1 / 64
#: Counters of the sketch of frequent keys; its counts are off by less than one row in 4,000.
TRACKED = 10_000


def spread_join(
    facts: DataFrame, lookup: DataFrame, on: str, spread_by: list[str], how: str = "left", fan: int = FAN
) -> DataFrame:
    """Join many fact rows to a lookup table with one row per key.

    One key may own a large part of the facts, so it is split into ``fan`` parts by the hash
    of ``spread_by``, and each lookup row is repeated once per part. The parts depend only on
    the row, so a recomputed task gives the same rows. The extra key also puts a shuffle of
    its own on both sides, which lets adaptive execution split a hot part further; a lookup
    grouped by ``on`` would reuse its grouping shuffle, and then cannot be split. The fan is
    small because Spark still broadcasts the lookup when the repeated rows are small enough.
    """
    part = "_part"
    spread = facts.withColumn(part, F.pmod(F.xxhash64(*spread_by), F.lit(fan)).cast("int"))
    copies = lookup.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    return spread.join(copies, [on, part], how).drop(part)


def hot_keys(df: DataFrame, on: str, share: float = HOT_SHARE) -> DataFrame:
    """One row with a map from each key above ``share`` of the rows to the number of its parts.

    The keys come from a mergeable sketch in one scan of one column; at most ``1 / share`` keys can
    be that frequent, so the map is small whatever the table holds.
    """
    most = 2 * ceil(1 / share)
    found = df.where(F.col(on).isNotNull()).agg(
        F.expr(f"approx_top_k(`{on}`, {most}, {max(TRACKED, most)})").alias("top"), F.count("*").alias("n")
    )
    limit = f"(n * {share!r}D)"
    return found.selectExpr(
        f"map_from_entries(transform(filter(top, x -> x.count > {limit}),"
        f" x -> struct(x.item, cast(ceil(x.count / {limit}) AS int)))) AS parts"
    )


def skew_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: list[str],
    how: str = "left",
    share: float = HOT_SHARE,
    measured: DataFrame | None = None,
) -> DataFrame:
    """As ``spread_join``, but only keys that were measured to be hot are split, by their share.

    The key's frequency in ``measured`` (the facts, unless a cheaper table stands for them) decides
    the number of its parts; the lookup rows of all other keys are not repeated. Facts with a NULL
    key match nothing and are spread as widely as a key can be. The measuring is a scalar
    subquery of the join, so nothing runs before the result is asked for. Rows are the same
    whatever was measured.
    """
    part = "_part"
    hot = hot_keys((facts if measured is None else measured).select(on), on, share).scalar()
    parts = F.when(F.col(on).isNull(), F.lit(ceil(1 / share))).otherwise(
        F.coalesce(F.try_element_at(hot, F.col(on)), F.lit(1))
    )
    spread = facts.withColumn(part, F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
    copies = lookup.where(F.col(on).isNotNull()).withColumn(part, F.explode(F.sequence(F.lit(0), parts - 1)))
    return spread.join(copies, [on, part], how).drop(part)
