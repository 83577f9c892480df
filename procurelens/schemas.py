"""Canonical tables and the typed summary.

The column names, keys and types below are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


PURCHASES = _table(
    ("vendornumber", T.LongType()),
    ("vendorname", T.StringType()),
    ("brand", T.LongType()),
    ("description", T.StringType()),
    ("purchaseprice", MONEY),
    ("quantity", T.LongType()),
    ("dollars", MONEY),
)

PURCHASE_PRICES = _table(
    ("vendornumber", T.LongType()),
    ("brand", T.LongType()),
    ("price", MONEY),
    ("volume", T.StringType()),
)

VENDOR_INVOICE = _table(
    ("vendornumber", T.LongType()),
    ("ponumber", T.LongType()),
    ("freight", MONEY),
)

SALES = _table(
    ("vendorno", T.LongType()),
    ("brand", T.LongType()),
    ("salesquantity", T.LongType()),
    ("salesdollars", MONEY),
    ("salesprice", MONEY),
    ("excisetax", MONEY),
)

RAW_SCHEMAS = {
    "purchases": PURCHASES,
    "purchase_prices": PURCHASE_PRICES,
    "vendor_invoice": VENDOR_INVOICE,
    "sales": SALES,
}

# The vendor key has another name in the sales table.
VENDOR_KEYS = {
    "purchases": "vendornumber",
    "purchase_prices": "vendornumber",
    "vendor_invoice": "vendornumber",
    "sales": "vendorno",
}

SUMMARY_KEY = ["vendornumber", "brand"]

SUMMARY_COLUMNS = [
    "vendornumber",
    "vendorname",
    "brand",
    "description",
    "purchaseprice",
    "actual_price",
    "volume",
    "total_purchase_quantity",
    "total_purchase_dollars",
    "total_sales_quantity",
    "total_sales_dollars",
    "total_sales_price",
    "total_excise_tax",
    "freight_cost",
]

METRIC_COLUMNS = ["gross_profit", "profit_margin", "stock_turnover", "sales_to_purchase_ratio"]

SALES_MEASURES = ["total_sales_quantity", "total_sales_dollars", "total_sales_price", "total_excise_tax"]

# Precision of the metrics when first stored (fixed values).
METRIC_STORAGE = {
    "gross_profit": "decimal(12,2)",
    "profit_margin": "decimal(10,2)",
    "stock_turnover": "decimal(10,4)",
    "sales_to_purchase_ratio": "decimal(10,4)",
}

# Final column types of the strict summary (fixed values); the two sums stay as they are.
STRICT_TYPES = {
    "vendornumber": "int",
    "brand": "int",
    "purchaseprice": "decimal(15,2)",
    "actual_price": "decimal(15,2)",
    "volume": "decimal(10,2)",
    "total_purchase_dollars": "decimal(15,2)",
    "total_sales_dollars": "decimal(15,2)",
    "total_sales_price": "decimal(15,2)",
    "total_excise_tax": "decimal(15,2)",
    "freight_cost": "decimal(15,2)",
    "gross_profit": "decimal(15,2)",
    "profit_margin": "decimal(15,2)",
    "stock_turnover": "decimal(15,2)",
    "sales_to_purchase_ratio": "decimal(15,2)",
}

STRICT_TEXT_LIMIT = 100
STRICT_TEXT = ["vendorname", "description"]
