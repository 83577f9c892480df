"""Numeric parsing and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java also parses type suffixes ("1d") and hexadecimal floats; those are not numbers here.
_JAVA_ONLY = r"(?i)x|[0-9.][df]\s*$"


def lenient_double(text: Column) -> Column:
    """The number in a text column, NULL where there is none."""
    text = text.cast("string")
    return F.when(~text.rlike(_JAVA_ONLY), text.try_cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where bottom is 0, NULL where either is NULL."""
    return F.when(bottom == 0, F.lit(0)).otherwise(top / bottom)


def without_nan(value: Column) -> Column:
    """NaN becomes NULL."""
    return F.when(~F.isnan(value), value)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def decimals_as_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def round_columns(df: DataFrame, digits: int) -> DataFrame:
    """Round every fractional column of the frame."""
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)]
    return df.withColumns({c: F.round(c, digits) for c in fractional})
