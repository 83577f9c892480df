"""Names with the largest totals, without a shuffle of every name.

A plain top list groups all names, though ten are wanted. Here the first pass folds each task's Arrow
batches into at most ``CAPACITY`` weighted counters (the Misra-Gries rule: when there are more, the
largest one that does not fit is taken off all). What a task took off bounds what it may have missed
of any name, so over all tasks

    counter <= total <= counter + lost,    lost = the sum of what the tasks took off.

If the counter of the last wanted place exceeds ``lost``, then a name without a counter cannot reach
it, not even as a tie, and a second pass sums exactly the names whose upper bound does. If it does
not exceed it (names of much the same size), all names are grouped plainly. The rows are the same
either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procurelens.operators.ranking import TOP, top_rows
from procurelens.session import work_dir

#: Counters of a task: names above one part in 4,096 of all weight are told apart from the rest.
CAPACITY = 4096
#: Most names that are sent to the tasks of the second pass.
MOST_CANDIDATES = 100_000
#: Allowance for the rounding of sums of doubles.
ROUNDING = 1e-6


def reduced(names: pa.Table, capacity: int) -> tuple[pa.Table, float]:
    """Counters of the same name added up, at most ``capacity`` left, and what was taken off each."""
    added = names.group_by("name").aggregate([("weight", "sum")]).select(["name", "weight_sum"]).rename_columns(["name", "weight"])
    if added.num_rows <= capacity:
        return added, 0.0
    weights = added["weight"].to_numpy()
    off = float(np.partition(weights, -capacity - 1)[-capacity - 1])
    good = weights > off
    return pa.table({"name": added["name"].filter(pa.array(good)), "weight": weights[good] - off}), off


def _counters(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, lost = None, 0.0
        for batch in batches:
            part = pa.table({"name": batch.column(0), "weight": batch.column(1)})
            weights = part["weight"].to_numpy()
            # The bounds need weights of at least 0; otherwise nothing can be told apart.
            lost += 0.0 if (weights >= 0).all() else np.inf
            kept, off = reduced(part if kept is None else pa.concat_tables([kept, part]), capacity)
            lost += off
        if kept is not None:
            end = pa.table({"name": pa.nulls(1, kept.schema.field("name").type), "weight": pa.nulls(1, pa.float64())})
            rows = pa.concat_tables([kept, end]).combine_chunks()
            loss = np.zeros(rows.num_rows)
            loss[-1] = lost
            yield from rows.append_column("lost", pa.array(loss)).to_batches()

    return run


def candidates(
    df: DataFrame, name: str, value: str | None, rows: int, capacity: int = CAPACITY, most: int = MOST_CANDIDATES
) -> DataFrame | None:
    """The names that may be among the ``rows`` largest, ties included; None if the bound cannot tell.

    The counters are written to the work folder, so that the table is read once and a lost
    executor costs no second scan.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # two zeros and many NaNs
        return None
    weight = F.lit(1.0) if value is None else F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    given = df.select(F.col(name).alias("name"), weight.alias("weight"))
    schema = T.StructType([T.StructField("name", kind), T.StructField("weight", T.DoubleType()), T.StructField("lost", T.DoubleType())])
    spark, path = df.sparkSession, work_dir(df.sparkSession, "heavy-names")
    # The rows that carry a loss have no weight, and a name that is NULL has one.
    given.mapInArrow(_counters(capacity), schema).groupBy("name", F.col("weight").isNull().alias("end")).agg(
        F.sum("weight").alias("weight"), F.sum("lost").alias("lost")
    ).write.parquet(path)
    counted = spark.read.parquet(path)
    lost = counted.agg(F.sum("lost")).head()[0]
    best = counted.where("NOT end").orderBy(F.desc("weight")).select("weight").limit(rows).collect()
    if lost is None or len(best) < rows or not best[-1][0] * (1 - ROUNDING) > lost * (1 + ROUNDING):
        return None
    floor = best[-1][0] * (1 - ROUNDING) - lost * (1 + ROUNDING)
    some = counted.where(~F.col("end") & (F.col("weight") >= floor)).select("name")
    return some if some.count() <= most else None


def top_names(df: DataFrame, name: str, value: str | None = None, rows: int = TOP, capacity: int = CAPACITY) -> DataFrame:
    """(name, total) of the largest sums of ``value``, or of the most rows; ties go by name."""
    some = candidates(df, name, value, rows, capacity)
    if some is not None:
        # At most ``MOST_CANDIDATES`` names, counted above.
        df = df.join(F.broadcast(some), df[name].eqNullSafe(some["name"]), "left_semi")
    total = F.count("*") if value is None else F.sum(value)
    return top_rows(df.groupBy(F.col(name).alias("name")).agg(total.alias("total")), "total", "name", rows)
