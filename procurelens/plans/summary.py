"""The vendor-brand summary: what each pair bought, sold and paid for freight."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procurelens.operators.joins import spread_join
from procurelens.schemas import SUMMARY_COLUMNS
from procurelens.session import work_dir

#: Vendors whose freight is broadcast, of some 50 bytes each.
BROADCAST_VENDORS = 1_000_000
LINE_KEYS = ["vendornumber", "vendorname", "brand", "description", "purchaseprice"]


def freight_by_vendor(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("vendornumber").agg(F.sum("freight").alias("freight_cost"))


def purchase_totals(purchases: DataFrame, prices: DataFrame) -> DataFrame:
    """Quantities and dollars per vendor, brand and price, for lines with a positive price.

    Prices are matched on the brand alone, so a brand with several price rows yields each
    purchase once per price row. Both sides are grouped before they meet: the join then sees
    one row per group instead of one per purchase line, and identical price rows act as a
    multiplier. No grouping is needed after it, for the joined keys are unique already.
    """
    lines = (
        purchases.where(F.col("purchaseprice") > 0)
        .groupBy(*LINE_KEYS)
        .agg(F.sum("quantity").alias("quantity"), F.sum("dollars").alias("dollars"))
    )
    tariffs = prices.groupBy("brand", F.col("price").alias("actual_price"), "volume").agg(
        F.count("*").alias("copies")
    )
    return join_purchases(lines, tariffs)


def join_purchases(lines: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Grouped purchase lines and grouped prices with their copies, matched on the brand."""
    dollars_type = lines.schema["dollars"].dataType
    return lines.join(tariffs, "brand").select(
        *LINE_KEYS,
        "actual_price",
        "volume",
        (F.col("quantity") * F.col("copies")).alias("total_purchase_quantity"),
        (F.col("dollars") * F.col("copies")).cast(dollars_type).alias("total_purchase_dollars"),
    )


def sales_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("vendorno", "brand").agg(
        F.sum("salesquantity").alias("total_sales_quantity"),
        F.sum("salesdollars").alias("total_sales_dollars"),
        F.sum("salesprice").alias("total_sales_price"),
        F.sum("excisetax").alias("total_excise_tax"),
    )


def vendor_summary(tables: Mapping[str, DataFrame], ordered: bool = True) -> DataFrame:
    """One row per purchase group with its sales and its vendor's freight.

    Pairs without sales and vendors without invoices stay, with NULLs. ``freight_cost`` is a
    figure of the vendor and repeats on each of its rows: do not add it up over rows.
    """
    bought = purchase_totals(tables["purchases"], tables["purchase_prices"])
    sold = sales_totals(tables["sales"]).withColumnRenamed("vendorno", "vendornumber")
    return join_summary(bought, sold, freight_by_vendor(tables["vendor_invoice"]), ordered)


def join_summary(
    bought: DataFrame, sold: DataFrame, freight: DataFrame, ordered: bool = True,
    broadcast_vendors: int = BROADCAST_VENDORS,
) -> DataFrame:
    """Grouped purchases with grouped sales and freight.

    The freight join is on the vendor alone, and no join before it deals the pairs by vendor. So the
    freight, one row per vendor, is written first: up to ``BROADCAST_VENDORS`` rows go to every executor
    and the wide pairs stay where they are. Beyond that the pairs are shuffled, and as one vendor may own a
    third of them, spread. The other joins are not hinted: Spark broadcasts by measured size.
    """
    spark, path = bought.sparkSession, work_dir(bought.sparkSession, "freight")
    freight.write.parquet(path)
    costs = spark.read.schema(freight.schema).parquet(path)
    pairs = bought.join(sold, ["vendornumber", "brand"], "left")
    if costs.count() <= broadcast_vendors:
        joined = pairs.join(F.broadcast(costs), "vendornumber", "left")
    else:
        joined = spread_join(pairs, costs, "vendornumber", spread_by=["brand"])
    summary = joined.select(*SUMMARY_COLUMNS)
    if ordered:
        # The keys after the amount make the order total, and let a range sort split ties.
        summary = summary.orderBy(F.desc_nulls_first("total_purchase_dollars"), "vendornumber", "brand")
    return summary
