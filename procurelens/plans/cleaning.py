"""Two ways to clean the summary and add the metrics.

``lenient`` works in doubles, fills every gap with 0 and never fails on bad text.
``strict`` works in decimals, fills only the sales measures, and fails on bad values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procurelens.functions.numbers import decimals_as_double, lenient_double, numeric_columns, ratio_or_zero
from procurelens.functions.text import strip, trim_spaces, within
from procurelens.schemas import METRIC_STORAGE, SALES_MEASURES, STRICT_TEXT, STRICT_TEXT_LIMIT, STRICT_TYPES


def gross_profit() -> Column:
    return F.col("total_sales_dollars") - F.col("total_purchase_dollars")


def profit_margin() -> Column:
    """Per cent of sales; 0 without sales. Needs ``gross_profit``."""
    return ratio_or_zero(F.col("gross_profit"), F.col("total_sales_dollars")) * 100


def stock_turnover() -> Column:
    return ratio_or_zero(F.col("total_sales_quantity"), F.col("total_purchase_quantity"))


def sales_to_purchase_ratio() -> Column:
    return ratio_or_zero(F.col("total_sales_dollars"), F.col("total_purchase_dollars"))


def add_metrics(df: DataFrame) -> DataFrame:
    return df.withColumn("gross_profit", gross_profit()).withColumns(
        {
            "profit_margin": profit_margin().cast("double"),
            "stock_turnover": stock_turnover().cast("double"),
            "sales_to_purchase_ratio": sales_to_purchase_ratio().cast("double"),
        }
    )


def clean_lenient(summary: DataFrame) -> DataFrame:
    """Parse the volume, fill every gap with 0, strip the texts, add the metrics.

    The fill comes before the text step, so a missing name becomes the text "0".
    """
    df = decimals_as_double(summary)
    if "volume" in df.columns:
        df = df.withColumn("volume", lenient_double(F.col("volume")))
    df = df.fillna(0, subset=numeric_columns(df))
    texts = [c for c in STRICT_TEXT if c in df.columns]
    df = df.withColumns({c: strip(F.coalesce(F.col(c).cast("string"), F.lit("0"))) for c in texts})
    return add_metrics(df)


def trim_vendor_names(df: DataFrame) -> DataFrame:
    return df.withColumn("vendorname", trim_spaces(F.col("vendorname")))


def fill_sales_gaps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in SALES_MEASURES})


def add_stored_metrics(df: DataFrame) -> DataFrame:
    """Metrics in their storage precision; the margin uses the already rounded profit."""
    exact = df.withColumns(
        {
            c: F.col(c).cast("decimal(20,0)" if isinstance(df.schema[c].dataType, T.IntegralType) else "decimal(17,2)")
            for c in (
                "total_sales_dollars", "total_purchase_dollars", "total_sales_quantity", "total_purchase_quantity"
            )
        }
    ).withColumn("gross_profit", gross_profit().cast(METRIC_STORAGE["gross_profit"]))
    stored = {
        "profit_margin": profit_margin(),
        "stock_turnover": stock_turnover(),
        "sales_to_purchase_ratio": sales_to_purchase_ratio(),
    }
    exact = exact.withColumns({c: e.cast(METRIC_STORAGE[c]) for c, e in stored.items()})
    # Sums keep the types they came with.
    return exact.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in df.schema.fields})


def standard_types(df: DataFrame, strict_volume: bool = True) -> DataFrame:
    """The typed 18-column projection. A text that does not fit is an error."""
    def typed(name: str) -> Column:
        column = F.col(name)
        if name in STRICT_TEXT:
            column = within(column, STRICT_TEXT_LIMIT)
        elif name == "volume" and not strict_volume:
            column = column.try_cast(STRICT_TYPES[name])
        elif name in STRICT_TYPES:
            column = column.cast(STRICT_TYPES[name])
        return column.alias(name)

    return df.select(*[typed(c) for c in df.columns])


def clean_strict(summary: DataFrame, strict_volume: bool = True) -> DataFrame:
    """Trim names, fill sales gaps, add stored metrics, fix the types.

    With ``strict_volume`` a volume that is not a number stops the job; without, it is NULL.
    """
    return standard_types(add_stored_metrics(fill_sales_gaps(trim_vendor_names(summary))), strict_volume)


CLEANERS = {"lenient": clean_lenient, "strict": clean_strict}
