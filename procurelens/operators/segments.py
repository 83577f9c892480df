"""Segments of the summary: profitable pairs, slow movers, target brands, order sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procurelens.operators.joins import skew_join
from procurelens.operators.quantiles import quantile_row, with_thresholds

# Fixed values of the reports.
LOW_SALES_QUANTILE = 0.15
HIGH_MARGIN_QUANTILE = 0.85
SMALL_BRAND_SALES = 10_000
ORDER_SIZES = ["Small", "Medium", "Large"]

PROFITABLE = "gross_profit > 0 AND profit_margin > 0 AND total_sales_quantity > 0"
SLOW = "stock_turnover < 1"


def profitable(summary: DataFrame) -> DataFrame:
    return summary.where(PROFITABLE)


def _mean_turnover(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vendorname").agg(F.avg("stock_turnover").alias("avg_stock"))


def low_turnover(summary: DataFrame) -> DataFrame:
    """Mean turnover per vendor over its slow rows, slowest first."""
    return _mean_turnover(summary.where(SLOW)).orderBy("avg_stock", "vendorname")


def low_turnover_profitable(summary: DataFrame) -> DataFrame:
    return low_turnover(profitable(summary))


def low_turnover_having(summary: DataFrame) -> DataFrame:
    """Vendors whose mean over all their rows is slow."""
    return _mean_turnover(summary).where("avg_stock < 1").orderBy("avg_stock", "vendorname")


def brand_performance(summary: DataFrame) -> DataFrame:
    """Sales and mean margin per brand, over the profitable rows."""
    return (
        profitable(summary)
        .groupBy("description")
        .agg(F.sum("total_sales_dollars").alias("total_sales"), F.avg("profit_margin").alias("avg_profit_margin"))
    )


def brand_thresholds(performance: DataFrame) -> DataFrame:
    return quantile_row(
        performance,
        {
            "low_sales_threshold": ("total_sales", LOW_SALES_QUANTILE),
            "high_margin_threshold": ("avg_profit_margin", HIGH_MARGIN_QUANTILE),
        },
    )


def _is_target():
    return (F.col("total_sales") <= F.col("low_sales_threshold")) & (
        F.col("avg_profit_margin") >= F.col("high_margin_threshold")
    )


def _with_brand_thresholds(summary: DataFrame) -> DataFrame:
    performance = brand_performance(summary)
    return with_thresholds(performance, brand_thresholds(performance))


def brand_categories(summary: DataFrame) -> DataFrame:
    """Every brand with the thresholds and its label, smallest sales first."""
    label = F.when(_is_target(), F.lit("Target Brand")).otherwise(F.lit("Other Brand"))
    return (
        _with_brand_thresholds(summary)
        .withColumn("brand_category", label)
        .orderBy("total_sales", "description")
    )


def target_brands(summary: DataFrame) -> DataFrame:
    """Brands with low sales and a high margin."""
    return (
        _with_brand_thresholds(summary)
        .where(_is_target())
        .select("description", "total_sales", "avg_profit_margin")
        .orderBy("total_sales", "description")
    )


def brand_scatter(summary: DataFrame) -> DataFrame:
    """Small brands with a target flag; the thresholds come from all brands."""
    return (
        _with_brand_thresholds(summary)
        .where(F.col("total_sales") < SMALL_BRAND_SALES)
        .withColumn("is_target", _is_target())
    )


def with_order_size(rows: DataFrame, column: str = "total_purchase_quantity") -> DataFrame:
    """Three classes at the tertiles of the quantity; edges belong to the lower class.

    Equal edges leave a class without a range, which is an error.
    """
    edges = quantile_row(
        rows,
        {
            "least": (column, 0.0),
            "first_tertile": (column, 1 / 3),
            "second_tertile": (column, 2 / 3),
            "most": (column, 1.0),
        },
    )
    distinct = "least < first_tertile AND first_tertile < second_tertile AND second_tertile < most"
    checked = edges.selectExpr(
        f"CASE WHEN {distinct} THEN first_tertile ELSE raise_error('order-size edges are not distinct') END AS small_to",
        "second_tertile AS medium_to",
    )
    small, medium, large = ORDER_SIZES
    size = F.expr(
        f"CASE WHEN {column} <= small_to THEN '{small}' WHEN {column} <= medium_to THEN '{medium}'"
        f" WHEN {column} IS NOT NULL THEN '{large}' END"
    )
    return with_thresholds(rows, checked).withColumn("order_size", size).select(*rows.columns, "order_size")


def with_unit_price(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "unit_purchase_price", F.try_divide("total_purchase_dollars", "total_purchase_quantity")
    )


def order_size_prices(summary: DataFrame) -> DataFrame:
    """Mean unit price per order size: does buying in bulk pay?"""
    rows = with_order_size(with_unit_price(profitable(summary)))
    return rows.groupBy("order_size").agg(F.avg("unit_purchase_price").alias("avg_unit_price"))


def with_unsold_value(rows: DataFrame) -> DataFrame:
    """Bought but not sold, at purchase price; negative when more was sold than bought."""
    return rows.withColumn(
        "unsold_value",
        (F.col("total_purchase_quantity") - F.col("total_sales_quantity")) * F.col("purchaseprice"),
    )


def unsold_total(summary: DataFrame) -> DataFrame:
    return with_unsold_value(profitable(summary)).agg(F.sum("unsold_value").alias("unsold_value"))


def unsold_by_vendor(summary: DataFrame) -> DataFrame:
    return (
        with_unsold_value(profitable(summary))
        .groupBy("vendorname")
        .agg(F.sum("unsold_value").alias("unsold_value"))
    )


def sales_below_price(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """Per vendor: lines sold, those under the brand's lowest price, and what they fell short of it.

    Lines meet the price list one by one, and one brand may own a third of them, so the brands that
    are frequent in the lines are split. Lines of brands without a price count as sold only.
    """
    lowest = prices.groupBy("brand").agg(F.min("price").alias("price"))
    priced = skew_join(sales, lowest, "brand", spread_by=["vendorno", "salesdollars", "salesprice"])
    short = (F.col("price") - F.col("salesprice")) * F.col("salesquantity")
    return priced.groupBy("vendorno").agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("salesprice") < F.col("price")).alias("lines_below"),
        F.sum(F.when(F.col("salesprice") < F.col("price"), short)).alias("shortfall"),
    )
