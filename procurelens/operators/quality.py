"""Checks on raw tables and on the summary."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procurelens.functions.text import bracketed, is_padded, show_spaces, trim_spaces
from procurelens.schemas import VENDOR_KEYS


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(df: DataFrame, rows: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first rows in a fixed order (all columns unless told otherwise)."""
    return df.orderBy(*(order or df.columns)).limit(rows)


def vendor_rows(tables: Mapping[str, DataFrame], vendor: int) -> DataFrame:
    """Every raw row of one vendor, tagged with its table; columns a table lacks are NULL."""
    parts = []
    for name, key in VENDOR_KEYS.items():
        rows = tables[name].where(F.col(key) == vendor).withColumnRenamed(key, "vendornumber")
        parts.append(rows.withColumn("table_name", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def vendor_purchases_by_price(purchases: DataFrame, vendor: int) -> DataFrame:
    return (
        purchases.where(F.col("vendornumber") == vendor)
        .groupBy("brand", "purchaseprice")
        .agg(F.sum("quantity").alias("total_quantity"), F.sum("dollars").alias("total_dollars"))
        .orderBy("brand", "purchaseprice")
    )


def vendor_sales_by_brand(sales: DataFrame, vendor: int) -> DataFrame:
    return (
        sales.where(F.col("vendorno") == vendor)
        .groupBy("brand")
        .agg(
            F.sum("salesdollars").alias("sales_dollars"),
            F.sum("salesprice").alias("sales_price"),
            F.sum("salesquantity").alias("sales_quantity"),
        )
    )


def duplicate_orders(invoices: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Order numbers that occur more than once, most frequent first; NULLs do not count.

    The check is on the order number alone unless ``keys`` adds the vendor.
    """
    keys = keys or ["ponumber"]
    return (
        invoices.groupBy(*keys)
        .agg(F.count("ponumber").alias("count_of_duplicates"))
        .where("count_of_duplicates > 1")
        .orderBy(F.desc("count_of_duplicates"), *keys)
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are repeated or have a NULL part, with the number of rows."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .withColumn("violation", F.when(missing, "null key").when(F.col("rows") > 1, "duplicate key"))
        .where("violation IS NOT NULL")
    )


class KeyViolation(ValueError):
    """Raised when a table does not have the key it should have."""


def require_key(df: DataFrame, keys: list[str]) -> None:
    """Run the key check; raise with a few offenders when it fails."""
    offenders = key_violations(df, keys).limit(5).collect()
    if offenders:
        raise KeyViolation(f"not a key: {keys}; for example {[r.asDict() for r in offenders]}")


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULLs of every column in one row, from one scan."""
    return df.agg(*[F.expr(f"count(*) - count(`{c}`) AS `{c}_nulls`") for c in columns or df.columns])


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, whether it may be NULL, and NULLs."""
    counts = null_profile(df)
    fields = [
        f"{i}, '{f.name}', '{f.dataType.simpleString()}', {str(f.nullable).lower()}, `{f.name}_nulls`"
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return counts.selectExpr(
        f"stack({len(fields)}, {', '.join(fields)}) AS (ordinal, column_name, data_type, is_nullable, nulls)"
    ).orderBy("ordinal")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def untrimmed(df: DataFrame, column: str = "vendorname") -> DataFrame:
    """Rows whose text begins or ends with spaces, with its length before and after."""
    text = F.col(column)
    return df.where(is_padded(text) | (text != trim_spaces(text))).select(
        column,
        F.char_length(text).alias("original_length"),
        F.char_length(trim_spaces(text)).alias("trimmed_length"),
    )


def visible_spaces(df: DataFrame, column: str = "vendorname") -> DataFrame:
    text = F.col(column)
    # The further sort columns let a range sort split the rows of a frequent text.
    order = [column, *[c for c in df.columns if c != column]]
    return df.where(is_padded(text)).orderBy(*order).select(column, show_spaces(text).alias("visible_whitespace"))


def still_padded(df: DataFrame, column: str = "vendorname") -> DataFrame:
    """What cleaning missed; empty after a good run."""
    text = F.col(column)
    return df.where(is_padded(text) | (text != trim_spaces(text))).select(
        column, F.char_length(text).alias("current_length"), bracketed(text).alias("visualized")
    )
