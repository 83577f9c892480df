"""Moments of all column pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from procurelens.operators import comoments, stats


def stacked_correlations(df, columns):
    """The same matrix from a row per pair and input row."""
    stack = ", ".join(f"'{a}', '{b}', `{a}`, `{b}`" for a in columns for b in columns)
    rows = df.selectExpr(*[f"nullif(cast(`{c}` AS double), double('NaN')) AS `{c}`" for c in columns])
    rows = rows.selectExpr(f"stack({len(columns) ** 2}, {stack}) AS (a, b, x, y)").where("x IS NOT NULL AND y IS NOT NULL")
    found = rows.groupBy("a", "b").agg(F.expr("try_divide(covar_pop(x, y), stddev_pop(x) * stddev_pop(y))").alias("corr"))
    return {(r.a, r.b): r["corr"] for r in found.collect()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_matrix_equals_the_stacked_one(spark, partitions):
    rng = np.random.default_rng(5)
    n = 3000
    base = rng.normal(1e6, 1, n)
    data = np.column_stack([base, base * 2 + rng.normal(0, 0.1, n), rng.lognormal(0, 3, n), np.full(n, 0.1), rng.integers(0, 3, n)])
    gaps = rng.random(data.shape) < [0, 0.2, 0.5, 0.1, 0.99]
    rows = [tuple(None if g else float(v) for v, g in zip(r, gap)) for r, gap in zip(data, gaps)]
    rows += [(float("nan"), 1.0, None, 0.1, None), (None,) * 5]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(partitions)
    want = stacked_correlations(df, df.columns)
    got = {(r.col_a, r.col_b): r["corr"] for r in stats.correlation_matrix(df).collect()}
    assert set(got) == set(want)
    # Sums of a constant's squares leave a remainder in the stacked form; here they are 0.
    assert all(value is None for pair, value in got.items() if "d" in pair)
    for pair, value in got.items():
        if "d" in pair:
            continue
        assert (value is None) == (want[pair] is None) and (value is None or value == pytest.approx(want[pair], abs=1e-9)), pair
    assert got["a", "a"] == pytest.approx(1, abs=1e-12)


def test_one_row_per_task(spark):
    df = spark.range(10_000, numPartitions=6).selectExpr("cast(id AS double) AS a", "cast(id % 7 AS double) AS b")
    tasks = comoments.task_moments(df, ["a", "b"])
    assert tasks.count() == 6
    by_pair = {r.pair: r for r in comoments.pair_moments(df, ["a", "b"]).collect()}
    a, b = np.arange(10_000.0), np.arange(10_000) % 7
    assert by_pair[2].n == 10_000 and by_pair[2].mean_x == pytest.approx(a.mean(), rel=1e-14)
    assert by_pair[2].m2_y == pytest.approx(((b - b.mean()) ** 2).sum(), rel=1e-12)
    assert by_pair[2].c == pytest.approx(((a - a.mean()) * (b - b.mean())).sum(), rel=1e-9)


def test_no_rows(spark):
    assert stats.correlation_matrix(spark.createDataFrame([], "a double, b int")).count() == 0
