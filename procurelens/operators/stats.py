"""Descriptive statistics, correlation, distributions, intervals and tests."""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procurelens.functions.numbers import numeric_columns
from procurelens.functions.student_t import t_quantile, t_tail
from procurelens.operators.comoments import column_pairs, pair_moments
from procurelens.operators.quantiles import (
    long_form,
    named_series,
    quantile_row,
    series_quantiles,
    with_thresholds,
)

# Fixed values of the reports.
BINS = 30
GRID = 200
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
CONFIDENCE = 0.95
SIGNIFICANCE = 0.05
TOP_SALES_QUANTILE = 0.75
LOW_SALES_QUANTILE = 0.25
WHISKER = 1.5

#: Sums that each cell of a density curve keeps.
TERMS = 18


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of each numeric column."""
    columns = columns or numeric_columns(df)
    moments = (
        long_form(df, columns, drop_missing=False)
        .groupBy("series")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    # Both sides have one row per column.
    quartiles = F.broadcast(series_quantiles(df, columns, QUARTILES))
    table = moments.join(quartiles, "series", "left").select(
        "series", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )
    return named_series(table, columns)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of all column pairs, over the rows where both are present.

    One pass over the rows gives the moments of all pairs (``comoments``), one row per task. NULL where
    a column is constant.
    """
    columns = columns or numeric_columns(df)
    pairs = column_pairs(columns)
    moments = pair_moments(df, columns).selectExpr("pair", "try_divide(c, sqrt(m2_x) * sqrt(m2_y)) AS corr")
    firsts = ", ".join(f"'{a}'" for a, _ in pairs)
    seconds = ", ".join(f"'{b}'" for _, b in pairs)
    named = moments.selectExpr(
        f"array({firsts})[pair] AS col_a",
        f"array({seconds})[pair] AS col_b",
        "CASE WHEN corr IS NOT NULL THEN greatest(-1D, least(1D, corr)) END AS corr",
    )
    # Mirror the upper triangle.
    both = "array(named_struct('col_a', col_a, 'col_b', col_b), named_struct('col_a', col_b, 'col_b', col_a))"
    return named.selectExpr("corr", f"inline(array_distinct({both})) AS (col_a, col_b)").select(
        "col_a", "col_b", "corr"
    )


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are kept.

    A constant column gets a range of one around its value.
    """
    columns = columns or numeric_columns(df)
    values = long_form(df, columns)
    extent = (
        values.groupBy("series").agg(F.min("value").alias("least"), F.max("value").alias("most"))
        .selectExpr(
            "series",
            "CASE WHEN least = most THEN least - 0.5D ELSE least END AS low",
            "CASE WHEN least = most THEN most + 0.5D ELSE most END AS high",
        )
    )
    guess = f"least(cast(floor((value - low) * {bins} / (high - low)) AS int), {bins - 1})"
    step = f"(high - low) / {bins}"
    # Rounding may put a value one bin off its edges; the edges decide.
    placed = (
        values.join(F.broadcast(extent), "series")
        .selectExpr("series", "value", "low", "high", f"{guess} AS guess")
        .selectExpr(
            "series",
            f"""CASE WHEN value < low + guess * ({step}) THEN guess - 1
                     WHEN guess < {bins - 1} AND value >= low + (guess + 1) * ({step}) THEN guess + 1
                     ELSE guess END AS bin""",
        )
        .groupBy("series", "bin")
        .agg(F.count("*").alias("rows"))
    )
    edges = extent.selectExpr("series", "low", "high", f"explode(sequence(0, {bins - 1})) AS bin").selectExpr(
        "series",
        "bin",
        f"low + bin * ({step}) AS bin_low",
        f"CASE WHEN bin = {bins - 1} THEN high ELSE low + (bin + 1) * ({step}) END AS bin_high",
    )
    # Both sides have at most ``bins`` rows per column.
    table = edges.join(F.broadcast(placed), ["series", "bin"], "left").selectExpr(
        "series", "bin", "bin_low", "bin_high", "coalesce(rows, 0) AS rows"
    )
    return named_series(table, columns)


def hermite(terms: int) -> list[list[int]]:
    """Coefficients of the first Hermite polynomials, lowest power first."""
    found = [[1], [0, 2]]
    for k in range(1, terms - 1):
        longer, shorter = [0, *[2 * c for c in found[k]]], found[k - 1]
        found.append([c - 2 * k * (shorter[j] if j < len(shorter) else 0) for j, c in enumerate(longer)])
    return found[:terms]


def density(df: DataFrame, columns: list[str] | None = None, grid: int = GRID, terms: int = TERMS) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, Scott's bandwidth.

    A fast Gauss transform: the axis is cut into cells, half as wide as the kernel's unit
    ``sqrt(2) * bandwidth``, and a value only adds the powers of its distance ``t`` from the middle of
    its cell to that cell's sums. With ``s`` the distance of a grid point from there,

        exp(-(s - t)^2) = exp(-s^2) * sum over k of H_k(s) * t^k / k!

    gives the cell's part of the curve from its sums, so the cost per row does not depend on the grid,
    and cells, not distinct values, are shuffled. As ``|t| <= 1/4``, the terms left out are below
    ``2 * 8^(-terms/2) / sqrt(terms!)`` per row, 2e-16 of a kernel's height with the 18 terms used.
    ``H_k`` is summed by powers of ``s``, whose rounding the factor ``exp(-s^2)`` keeps as small.
    Columns without spread have no density.
    """
    columns = columns or numeric_columns(df)
    values = long_form(df, columns)
    shape = (
        values.groupBy("series")
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.stddev_samp("value").alias("deviation"),
        )
        .where("deviation > 0")
        .selectExpr(
            "series", "n", "low", f"(high - low) / {grid - 1} AS step", "deviation * pow(n, -0.2D) AS bandwidth"
        )
    )
    # One row per column on the broadcast side.
    placed = (
        values.join(F.broadcast(shape), "series")
        .selectExpr("series", "(value - low) / (bandwidth * sqrt(2D)) AS place")
        .selectExpr("series", "floor(place * 2D) AS cell", "place")
        .selectExpr("series", "cell", "place - (cell + 0.5D) / 2D AS t1")
    )
    done = 1
    while done < terms - 1:
        more = range(done + 1, min(2 * done, terms - 1) + 1)
        placed = placed.selectExpr("*", *[f"t{k // 2} * t{k - k // 2} AS t{k}" for k in more])
        done = more[-1]
    sums = placed.groupBy("series", "cell").agg(
        F.expr("cast(count(*) AS double) AS m0"), *[F.sum(f"t{k}").alias(f"m{k}") for k in range(1, terms)]
    )
    polynomials = hermite(terms)
    powers = [
        " + ".join(f"{polynomials[k][j] / factorial(k)!r}D * m{k}" for k in range(j, terms, 2)) + f" AS b{j}"
        for j in range(terms)
    ]
    series_sum = f"b{terms - 1}"
    for j in reversed(range(terms - 1)):
        series_sum = f"b{j} + s * ({series_sum})"
    table = (
        sums.selectExpr("series", "cell", *powers)
        .join(F.broadcast(shape), "series")
        .selectExpr("*", f"explode(sequence(0, {grid - 1})) AS point")
        .selectExpr("*", "point * step / (bandwidth * sqrt(2D)) - (cell + 0.5D) / 2D AS s")
        .selectExpr("series", "point", f"exp(-s * s) * ({series_sum}) AS part")
        .groupBy("series", "point")
        .agg(F.sum("part").alias("k"))
        .join(F.broadcast(shape), "series")
        .selectExpr("series", "point", "low + point * step AS x", "k / (n * bandwidth * sqrt(2 * pi())) AS density")
    )
    return named_series(table, columns)


def box_stats(
    df: DataFrame, columns: list[str] | None = None, by: str | None = None, classes: list[str] | None = None
) -> DataFrame:
    """Quartiles, whiskers at the furthest point within 1.5 quartile ranges, and outliers."""
    columns = columns or numeric_columns(df)
    keys = [by, "series"] if by else ["series"]
    boxes = series_quantiles(df, columns, QUARTILES, by, classes).selectExpr(
        *keys, *QUARTILES, f"q1 - {WHISKER}D * (q3 - q1) AS fence_low", f"q3 + {WHISKER}D * (q3 - q1) AS fence_high"
    )
    values = long_form(df, columns, [by] if by else None)
    # One box per series and class.
    table = (
        values.join(F.broadcast(boxes), keys)
        .groupBy(*keys, *QUARTILES)
        .agg(
            F.expr("min(CASE WHEN value >= fence_low THEN value END) AS low"),
            F.expr("max(CASE WHEN value <= fence_high THEN value END) AS high"),
            F.expr("count_if(value < fence_low OR value > fence_high) AS outliers"),
        )
        .selectExpr(
            *keys, *QUARTILES, "least(low, q1) AS whisker_low", "greatest(high, q3) AS whisker_high", "outliers"
        )
    )
    return named_series(table, columns)


def mean_interval(df: DataFrame, value: str, by: list[str], confidence: float = CONFIDENCE) -> DataFrame:
    """Mean of a column per group with its Student-t confidence bounds."""
    level = F.lit((1 + confidence) / 2)
    return (
        df.dropna(subset=[value])
        .groupBy(*by)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
        .withColumn("std_err", F.col("std") / F.sqrt("n"))
        .withColumn("margin", t_quantile(level, F.col("n") - 1) * F.col("std_err"))
        .selectExpr(*by, "n", "mean", "std", "std_err", "mean - margin AS lower", "mean + margin AS upper")
    )


def sales_bands(rows: DataFrame) -> DataFrame:
    """Thresholds of the top and the low quarter by sales, in one row."""
    return quantile_row(
        rows,
        {
            "top_threshold": ("total_sales_dollars", TOP_SALES_QUANTILE),
            "low_threshold": ("total_sales_dollars", LOW_SALES_QUANTILE),
        },
    )


def with_band(rows: DataFrame) -> DataFrame:
    """Rows of the top and low bands, both ends inclusive; a row in both comes twice."""
    banded = with_thresholds(rows, sales_bands(rows))
    return banded.withColumn(
        "band",
        F.expr(
            """explode(array_compact(array(
                 CASE WHEN total_sales_dollars >= top_threshold THEN 'top' END,
                 CASE WHEN total_sales_dollars <= low_threshold THEN 'low' END)))"""
        ),
    )


def margin_intervals(rows: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    return mean_interval(with_band(rows), "profit_margin", ["band"], confidence)


def welch_test(df: DataFrame, value: str, first: Column, second: Column, alpha: float = SIGNIFICANCE) -> DataFrame:
    """Two-sample t-test without equal variances, from one aggregate over both samples."""
    def sample(condition: Column, suffix: str) -> list[Column]:
        x = F.when(condition & ~F.isnan(value), F.col(value))
        return [
            F.count(x).alias(f"n_{suffix}"),
            F.avg(x).alias(f"mean_{suffix}"),
            F.var_samp(x).alias(f"var_{suffix}"),
        ]

    return (
        df.agg(*sample(first, "a"), *sample(second, "b"))
        .selectExpr("*", "try_divide(var_a, n_a) AS sq_a", "try_divide(var_b, n_b) AS sq_b")
        .selectExpr(
            "n_a", "mean_a", "n_b", "mean_b",
            "try_divide(mean_a - mean_b, sqrt(sq_a + sq_b)) AS t_stat",
            "try_divide(pow(sq_a + sq_b, 2), "
            "try_divide(pow(sq_a, 2), n_a - 1) + try_divide(pow(sq_b, 2), n_b - 1)) AS df",
        )
        .withColumn("p_value", t_tail(F.col("t_stat"), F.col("df")))
        .withColumn("reject", F.col("p_value") < alpha)
    )


def margin_welch(rows: DataFrame, alpha: float = SIGNIFICANCE) -> DataFrame:
    """Do the margins of the top and the low band differ?"""
    banded = with_thresholds(rows, sales_bands(rows))
    return welch_test(
        banded,
        "profit_margin",
        F.col("total_sales_dollars") >= F.col("top_threshold"),
        F.col("total_sales_dollars") <= F.col("low_threshold"),
        alpha,
    )
