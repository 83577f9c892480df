"""Canonical procurement tables derived from a star-schema Parquet folder.

Suppliers play vendors, parts play brands; open lines are purchases and finished lines are
sales. Stray spaces, zero prices and a textual volume are put in so that cleaning has work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"

# Columns in use; a stated schema spares the job that infers one.
STAR_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_linestatus string"
    ),
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _hundredths(name: str) -> Column:
    """Whole cents (or per cents) of a double that carries two decimals."""
    return F.rint(F.col(name) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(15,0)") * F.expr("0.01")).cast(MONEY)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    # Purchase price = 1.6 times the list price, kept in tenths of a cent until it is rounded.
    parts = _read(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("description"),
        F.when(F.col("p_size") == 50, F.lit(0)).otherwise(_hundredths("p_retailprice") * 16).alias("tenths"),
    ).withColumn("purchaseprice", _money(F.expr("(tenths + 5) div 10")))
    suppliers = _read(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("  "), "s_name", F.lit(" ")))
        .otherwise(F.col("s_name")).alias("vendorname"),
    )
    # The join on the part comes last: lines move by supplier before they carry a part's texts, and stay
    # dealt by brand for what groups and joins by brand next.
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("l_suppkey").alias("vendornumber"),
            "vendorname",
            F.col("l_partkey").alias("brand"),
            "description",
            "purchaseprice",
            F.col("l_quantity").cast("bigint").alias("quantity"),
            _money(F.expr("(tenths * cast(l_quantity as bigint) + 5) div 10")).alias("dollars"),
        )
    )


def purchase_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 10).alias("vendornumber"),
        F.col("p_partkey").alias("brand"),
        _money(_hundredths("p_retailprice") * 2).alias("price"),
        F.when(F.col("p_size") == 49, F.lit("Unknown"))
        .otherwise((F.col("p_size") * 50).cast("string")).alias("volume"),
    )


def vendor_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per vendor and order; the tax of its lines plays the freight."""
    return (
        _read(spark, sf_dir, "lineitem")
        .where("l_linestatus = 'O' AND l_suppkey % 7 <> 0")
        .groupBy(F.col("l_suppkey").alias("vendornumber"), F.col("l_orderkey").alias("ponumber"))
        .agg(F.sum(_hundredths("l_extendedprice") * _hundredths("l_tax")).alias("freight"))
        .withColumn("freight", _money(F.expr("(freight + 50) div 100")))
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(
        "l_suppkey",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _hundredths("l_extendedprice").alias("amount"),
        _hundredths("l_discount").alias("discount"),
        _hundredths("l_tax").alias("tax"),
    )
    return lines.select(
        F.col("l_suppkey").alias("vendorno"),
        F.col("l_partkey").alias("brand"),
        F.col("quantity").alias("salesquantity"),
        _money(F.expr("(amount * (100 - discount) + 50) div 100")).alias("salesdollars"),
        _money(F.expr("(2 * amount + quantity) div nullif(2 * quantity, 0)")).alias("salesprice"),
        _money(F.expr("(amount * tax + 50) div 100")).alias("excisetax"),
    )


def begin_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("brand"),
        F.col("p_size").alias("onhand"),
        _money(_hundredths("p_retailprice")).alias("price"),
    )


def end_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock at the end: what is left of the opening stock after a third, rounded up, is sold."""
    return begin_inventory(spark, sf_dir).withColumn("onhand", F.expr("onhand - (onhand + 2) div 3").cast("int"))


TABLES = {
    "purchases": purchases,
    "purchase_prices": purchase_prices,
    "vendor_invoice": vendor_invoice,
    "sales": sales,
    "begin_inventory": begin_inventory,
    "end_inventory": end_inventory,
}


class StarTables(Mapping):
    """The six canonical tables of a folder; each is declared when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return TABLES[name](self._spark, self._dir)

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def load(spark: SparkSession, sf_dir: str) -> StarTables:
    return StarTables(spark, sf_dir)
