"""Exact interpolated quantiles without a global sort or a one-task map of all values.

Two passes over the input:

1. a mergeable sketch gives, per wanted quantile, a low and a high bound around it;
2. values between the bounds are counted one by one, all others only in bulk, so running
   counts give the exact rank of every value near the quantile.

Both passes combine on the map side, so a value that fills a third of the table is one row by
then. What one task sorts at the end is the distinct values between the bounds: at most
``(2 * SLACK + 2) / ACCURACY`` of the rows per quantile (one in 1,000), for a sketch value is
off by at most ``1 / ACCURACY`` of the ranks. The bounds that are broadcast are one row per
series, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
SLACK = 4


def long_form(
    df: DataFrame, columns: list[str], keep: list[str] | None = None, drop_missing: bool = True
) -> DataFrame:
    """Rows (kept columns, series, value) of the columns as doubles; NaN counts as missing.

    ``series`` is the position in ``columns``: numbers join and group faster than names.
    """
    pairs = ", ".join(f"{i}, nullif(cast(`{c}` AS double), double('NaN'))" for i, c in enumerate(columns))
    rows = df.selectExpr(*(keep or []), f"stack({len(columns)}, {pairs}) AS (series, value)")
    return rows.where("value IS NOT NULL") if drop_missing else rows


def named_series(df: DataFrame, columns: list[str]) -> DataFrame:
    """Put the column names back in place of their positions."""
    names = ", ".join(f"'{c}'" for c in columns)
    return df.withColumn("series", F.expr(f"array({names})[series]"))


def series_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: dict[str, float],
    by: str | None = None,
    classes: list[str] | None = None,
) -> DataFrame:
    """As ``exact_quantiles``, with positions for series."""
    keys = [by, "series"] if by else ["series"]
    values = long_form(df, columns, [by] if by else None)
    if by:
        values = values.where(F.col(by).isin(*classes))
    levels = sorted(set(probs.values()))
    margin = SLACK / ACCURACY
    edges = [edge for p in levels for edge in (max(p - margin, 0.0), min(p + margin, 1.0))]
    listed = ", ".join(f"{e!r}D" for e in edges)
    bounds = values.groupBy(*keys).agg(F.expr(f"percentile_approx(value, array({listed}), {ACCURACY}) AS edges"))

    pairs = [(f"edges[{2 * i}]", f"edges[{2 * i + 1}]") for i in range(len(levels))]
    near = " OR ".join(f"value BETWEEN {low} AND {high}" for low, high in pairs)
    # Values outside all bounds hang on the upper bound below them, NULL before the first.
    passed = ", ".join(f"CASE WHEN value > {high} THEN {high} END" for _, high in reversed(pairs))
    counted = (
        values.join(F.broadcast(bounds), keys)
        .selectExpr(*keys, "value", f"NOT ({near}) AS bulk", f"coalesce({passed}) AS passed")
        .selectExpr(*keys, "value", "bulk", "CASE WHEN bulk THEN passed ELSE value END AS anchor")
        .groupBy(*keys, "anchor", "bulk")
        .agg(F.expr("count(*) AS n"), F.expr("min(value) AS low"), F.expr("max(value) AS high"))
    )
    series = ", ".join(keys)
    ranked = counted.selectExpr(
        *keys,
        "n",
        "low",
        "high",
        f"sum(n) OVER (PARTITION BY {series} ORDER BY anchor, bulk ROWS UNBOUNDED PRECEDING) - n AS before",
        f"sum(n) OVER (PARTITION BY {series}) AS total",
    )

    def position(level: float) -> str:
        return f"({level!r}D * (total - 1))"

    def value_at(rank: str) -> str:
        """The value with this rank; a bulk group only knows its first and its last one."""
        return (
            f"max(CASE WHEN {rank} < before OR {rank} >= before + n THEN NULL "
            f"WHEN {rank} = before OR low = high THEN low "
            f"WHEN {rank} = before + n - 1 THEN high "
            "ELSE raise_error('quantile outside its bounds') END)"
        )

    ends = []
    for name, level in probs.items():
        ends.append(F.expr(f"{value_at(f'floor({position(level)})')} AS {name}_lower"))
        ends.append(F.expr(f"{value_at(f'ceil({position(level)})')} AS {name}_upper"))
    located = ranked.groupBy(*keys).agg(F.expr("max(total) AS total"), *ends)
    return located.selectExpr(
        *keys,
        *[
            f"CASE WHEN {n}_lower = {n}_upper THEN {n}_lower ELSE {n}_lower + ({n}_upper - {n}_lower)"
            f" * ({position(p)} - floor({position(p)})) END AS {n}"
            for n, p in probs.items()
        ],
    )


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: dict[str, float],
    by: str | None = None,
    classes: list[str] | None = None,
) -> DataFrame:
    """Quantiles of each column, linearly interpolated between neighbouring values.

    Returns one row per series (and per class, when ``by`` names a column that holds one of
    the listed ``classes``) with a column per entry of ``probs``.
    """
    return named_series(series_quantiles(df, columns, probs, by, classes), columns)


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row of named thresholds, each the quantile of some column."""
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    probs = {f"p{i}": p for i, p in enumerate(dict.fromkeys(p for _, p in wanted.values()))}
    names = {p: n for n, p in probs.items()}
    table = series_quantiles(df, columns, probs)
    return table.agg(
        *[
            F.expr(f"max(CASE WHEN series = {columns.index(c)} THEN {names[p]} END) AS {name}")
            for name, (c, p) in wanted.items()
        ]
    )


def with_thresholds(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Put the values of a one-row frame on every row, as a scalar subquery (no join)."""
    row = thresholds.select(F.struct(*thresholds.columns)).scalar()
    named = df.withColumn("_row", row)
    return named.selectExpr(*df.columns, *[f"_row.{c} AS {c}" for c in thresholds.columns])
