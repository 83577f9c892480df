"""Means, squares and products of all column pairs in one pass, mergeable.

For each pair the rows count where both columns are present. A task folds its Arrow batches into one
row of counts, means and centred sums per pair: matrix products of the centred values and of the masks
of present values give those of a batch, and the parallel update formula

    n = na + nb,  d = mean_b - mean_a,  mean = mean_a + d nb / n,  m2 = m2_a + m2_b + d^2 na nb / n

(with the two columns' d multiplied for the products) merges batches and, in Spark, the rows of the
tasks. So a task sends one row, whatever it has read, and nothing is squared before it is centred.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups in which the rows of the tasks are merged first.
FAN = 64
_FIELDS = ["n", "mean_x", "mean_y", "m2_x", "m2_y", "c"]
_SCHEMA = ", ".join(f"{f} array<double>" for f in _FIELDS)


def column_pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, a) for a in columns] + list(combinations(columns, 2))


class Moments:
    """Counts, means (of the first column of a pair, where the second is present), squares and products."""

    def __init__(self, width: int):
        self.n, self.mean, self.m2, self.c = (np.zeros((width, width)) for _ in range(4))

    def add(self, values: np.ndarray) -> None:
        """Fold in rows; missing values are NaN."""
        there = ~np.isnan(values)
        seen = there.any(axis=0)
        low = np.where(seen, np.where(there, values, np.inf).min(axis=0, initial=np.inf), 0.0)
        high = np.where(seen, np.where(there, values, -np.inf).max(axis=0, initial=-np.inf), 0.0)
        count = np.maximum(there.sum(axis=0), 1)
        # A constant column is centred on its value itself, so that its squares are exactly 0.
        centre = np.where(low == high, low, np.where(there, values, 0.0).sum(axis=0) / count)
        off, mask = np.where(there, values - centre, 0.0), there.astype("float64")
        n, sums = mask.T @ mask, off.T @ mask
        size = np.maximum(n, 1)
        self.merge(n, centre[:, None] + sums / size, (off * off).T @ mask - sums * sums / size, off.T @ off - sums * sums.T / size)

    def merge(self, n: np.ndarray, mean: np.ndarray, m2: np.ndarray, c: np.ndarray) -> None:
        total = self.n + n
        size = np.maximum(total, 1)
        off = np.where((self.n > 0) & (n > 0), mean - self.mean, 0.0)
        both = self.n * n / size
        self.mean = np.where(self.n > 0, self.mean + off * n / size, mean)
        self.m2 += m2 + off * off * both
        self.c += c + off * off.T * both
        self.n = total


def _fold(columns: list[str]):
    place = {c: i for i, c in enumerate(columns)}
    first, second = (np.array([place[p[k]] for p in column_pairs(columns)]) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, rows = Moments(len(columns)), 0
        for batch in batches:
            if batch.num_rows:
                rows += batch.num_rows
                moments.add(np.column_stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns]))
        if rows:
            m = moments
            parts = [m.n[first, second], m.mean[first, second], m.mean[second, first], m.m2[first, second], m.m2[second, first], m.c[first, second]]
            yield pa.RecordBatch.from_arrays([pa.array([p]) for p in parts], _FIELDS)

    return run


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Partial moments of the same keys as one, by the update formula."""
    zero = F.struct(*[F.lit(0.0).alias(f) for f in _FIELDS])

    def update(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy, both = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"], a["n"] * b["n"] / n
        parts = [
            n, a["mean_x"] + dx * b["n"] / n, a["mean_y"] + dy * b["n"] / n,
            a["m2_x"] + b["m2_x"] + dx * dx * both, a["m2_y"] + b["m2_y"] + dy * dy * both, a["c"] + b["c"] + dx * dy * both,
        ]
        whole = F.struct(*[p.alias(f) for p, f in zip(parts, _FIELDS, strict=True)])
        return F.when(a["n"] == 0, b).otherwise(whole)

    listed = rows.where("n > 0").groupBy(*keys).agg(F.collect_list(F.struct(*_FIELDS)).alias("parts"))
    return listed.select(*keys, F.aggregate("parts", zero, update).alias("m")).select(*keys, "m.*")


def task_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per task that has rows: an array per measure, with a place per pair of ``column_pairs``."""
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return doubles.mapInArrow(_fold(columns), _SCHEMA)


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(pair, n, mean_x, mean_y, m2_x, m2_y, c) for each pair of ``column_pairs`` that has rows."""
    tasks = task_moments(df, columns).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    each = tasks.select("part", F.posexplode(F.arrays_zip(*_FIELDS)).alias("pair", "m")).select("part", "pair", "m.*")
    return _merged(_merged(each, ["part", "pair"]), ["pair"])
