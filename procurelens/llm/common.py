"""Helpers shared by the text operators: table reads, written intermediate tables, running totals."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procurelens.session import work_dir

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch that a worker turns into Python objects at a time.
STEP = 500


def release_memory() -> None:
    """Give what was freed back to the system; allocators keep it in the process otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A worker function that gives its memory back when its task ends, as Spark keeps the process for others."""
    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def in_steps(batches: Iterator[pa.RecordBatch], rows: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    This cuts the lineage in a place that every executor reaches, so a lost executor costs
    a few tasks and not the steps before, and a step with an order of its own runs once.
    """
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The documents, written once with a number of each row, and the column that holds it."""
    row = fresh(docs, "_row")
    return saved(spark, docs.withColumn(row, F.monotonically_increasing_id()), name), row


def bucket_bits(rows: int, per_bucket: int = 1000) -> int:
    """Bits that give buckets of about ``per_bucket`` rows."""
    return max(1, (max(rows, 1) // per_bucket).bit_length())


def running_total(
    df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str, fan_bits: int
) -> DataFrame:
    """Add ``out``, the sum of ``value`` over the rows before, per group and by bucket and order.

    ``bucket`` is a whole number that never falls along the order. Sums are taken inside
    buckets, over the buckets of a super-bucket (``2**fan_bits`` of them) and over
    super-buckets, so no window holds a whole group. Group columns must not be null.
    """
    def before(keys: list[str], by: list[str], col: str):
        window = W.partitionBy(*keys).orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(col).over(window), F.lit(0).cast("long"))

    leaf = [*group, bucket]
    totals = df.groupBy(*leaf).agg(F.sum(value).alias("_sum"))
    totals = totals.withColumn("_super", F.shiftright(bucket, fan_bits))
    upper = totals.groupBy(*group, "_super").agg(F.sum("_sum").alias("_upper_sum"))
    upper = upper.select(*group, "_super", before(group, ["_super"], "_upper_sum").alias("_base"))
    starts = totals.select(*leaf, "_super", before([*group, "_super"], [bucket], "_sum").alias("_inner"))
    starts = starts.join(upper, [*group, "_super"]).select(*leaf, (F.col("_inner") + F.col("_base")).alias("_start"))
    inside = df.withColumn("_local", before(leaf, order, value))
    return inside.join(starts, leaf).withColumn(out, F.col("_local") + F.col("_start")).drop("_local", "_start")
