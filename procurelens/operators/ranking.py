"""Top lists, shares and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from procurelens.functions.numbers import round_columns
from procurelens.functions.text import money_label
from procurelens.operators.segments import profitable

TOP = 10


def top_rows(df: DataFrame, value: str, name: str, rows: int = TOP, largest: bool = True) -> DataFrame:
    """The rows with the largest (or smallest) value; ties go by name."""
    order = F.desc(value) if largest else F.asc(value)
    return df.orderBy(order, name).limit(rows)


def frequency_top(df: DataFrame, column: str, rows: int = TOP) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return top_rows(counts, "rows", "value", rows).select(F.lit(column).alias("series"), "value", "rows")


def top_by_sales(summary: DataFrame, name: str, rows: int = TOP) -> DataFrame:
    """The names with the most sales among the profitable rows, with a money label."""
    totals = profitable(summary).groupBy(name).agg(
        F.round(F.sum("total_sales_dollars"), 2).alias("total_sales_dollars")
    )
    return top_rows(totals, "total_sales_dollars", name, rows).withColumn(
        "sales_label", money_label(F.col("total_sales_dollars"))
    )


def vendor_totals(summary: DataFrame) -> DataFrame:
    return profitable(summary).groupBy("vendorname").agg(
        F.sum("total_purchase_dollars").alias("total_purchase_dollars"),
        F.sum("gross_profit").alias("gross_profit"),
        F.sum("total_sales_dollars").alias("total_sales_dollars"),
    )


def with_share(df: DataFrame, column: str, share: str) -> DataFrame:
    """Per cent of the column's total; the total is a scalar subquery, not a global window."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(share, F.try_divide(F.col(column), total) * 100)


def top_purchase_shares(summary: DataFrame) -> DataFrame:
    """The vendors with the largest shares of purchases, everything rounded to two places."""
    return ranked_shares(summary).drop("place")


def ranked_shares(summary: DataFrame) -> DataFrame:
    """The top shares, rounded, with their place by the unrounded share.

    The window has no partition, but only the ten rows of the top list reach it.
    """
    shares = with_share(vendor_totals(summary), "total_purchase_dollars", "purchase_contribution")
    top = top_rows(shares, "purchase_contribution", "vendorname")
    place = F.row_number().over(Window.orderBy(F.desc("purchase_contribution"), "vendorname"))
    return round_columns(top.withColumn("place", place), 2)


def vendor_pareto(summary: DataFrame) -> DataFrame:
    """Top vendors with money labels and the running total of their rounded shares, in the order of the exact ones."""
    running = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = ranked_shares(summary).withColumn("cumulative_contribution", F.sum("purchase_contribution").over(running))
    return top.orderBy("place").drop("place").withColumns(
        {c: money_label(F.col(c)) for c in ("total_purchase_dollars", "gross_profit", "total_sales_dollars")}
    )


def top_concentration(summary: DataFrame) -> DataFrame:
    return top_purchase_shares(summary).agg(
        F.round(F.sum("purchase_contribution"), 2).alias("top10_contribution")
    )


def purchase_share_with_rest(summary: DataFrame) -> DataFrame:
    """Top shares plus one row for all other vendors."""
    top = top_purchase_shares(summary).select("vendorname", "purchase_contribution")
    rest = top.agg((F.lit(100) - F.sum("purchase_contribution")).alias("purchase_contribution")).select(
        F.lit("Other Vendors").alias("vendorname"), "purchase_contribution"
    )
    return top.unionByName(rest)


def unsold_top(unsold: DataFrame, rows: int = TOP) -> DataFrame:
    rounded = unsold.withColumn("unsold_value", F.round("unsold_value", 2))
    return top_rows(rounded, "unsold_value", "vendorname", rows).withColumn(
        "unsold_label", money_label(F.col("unsold_value"))
    )
