"""Small frames and comparisons for the tests."""

from decimal import Decimal

from procurelens.schemas import PURCHASE_PRICES, PURCHASES, SALES, VENDOR_INVOICE


def money(text):
    return None if text is None else Decimal(text)


def raw_tables(spark, purchases, prices, sales=(), invoices=()):
    """Canonical tables from tuples with money as text."""
    return {
        "purchases": spark.createDataFrame(
            [(v, n, b, d, money(p), q, money(a)) for v, n, b, d, p, q, a in purchases], PURCHASES
        ),
        "purchase_prices": spark.createDataFrame(
            [(v, b, money(p), x) for v, b, p, x in prices], PURCHASE_PRICES
        ),
        "sales": spark.createDataFrame(
            [(v, b, q, money(a), money(p), money(t)) for v, b, q, a, p, t in sales], SALES
        ),
        "vendor_invoice": spark.createDataFrame([(v, o, money(f)) for v, o, f in invoices], VENDOR_INVOICE),
    }


def rows(df):
    """Rows as a set-like sorted list of dicts."""
    return sorted((r.asDict() for r in df.collect()), key=lambda d: str(sorted(d.items(), key=lambda i: i[0])))


SUMMARY_DDL = """vendornumber bigint, vendorname string, brand bigint, description string, purchaseprice decimal(15,2),
 actual_price decimal(15,2), volume string, total_purchase_quantity bigint, total_purchase_dollars decimal(25,2),
 total_sales_quantity bigint, total_sales_dollars decimal(25,2), total_sales_price decimal(25,2),
 total_excise_tax decimal(25,2), freight_cost decimal(25,2)"""


def summary(spark, **changes):
    """One raw summary row with some values changed."""
    base = dict(
        vendornumber=1, vendorname="Acme", brand=10, description="Gin", purchaseprice="2.00", actual_price="3.00",
        volume="750", total_purchase_quantity=10, total_purchase_dollars="20.00", total_sales_quantity=5,
        total_sales_dollars="40.00", total_sales_price="8.00", total_excise_tax="1.00", freight_cost="4.00",
    )
    base.update(changes)
    amounts = {"purchaseprice", "actual_price", "total_purchase_dollars", "total_sales_dollars",
               "total_sales_price", "total_excise_tax", "freight_cost"}
    return spark.createDataFrame([tuple(money(v) if k in amounts else v for k, v in base.items())], SUMMARY_DDL)
