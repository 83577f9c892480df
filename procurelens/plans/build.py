"""The job that builds the summary table once, for many reports to read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from procurelens.operators.quality import require_key
from procurelens.plans.cleaning import CLEANERS
from procurelens.plans.summary import vendor_summary
from procurelens.schemas import SUMMARY_KEY
from procurelens.sources.tables import read_path, replace_path, replace_table


def build_summary(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    path: str,
    mode: str = "lenient",
    name: str | None = None,
    **options,
) -> DataFrame:
    """Summarise, clean, write in place of the old table, and return the written table.

    The strict mode also demands that vendor and brand are a key. Either mode writes a new version
    first and puts it in force when it is complete, so a job that fails leaves the old table as it
    was. Row order is left to the readers: Parquet files have none, and the sort would cost a
    shuffle. Errors are not caught.
    """
    return write_summary(spark, vendor_summary(tables, ordered=False), path, mode, name, **options)


def write_summary(
    spark: SparkSession, raw: DataFrame, path: str, mode: str = "lenient", name: str | None = None, **options
) -> DataFrame:
    """Clean a raw summary and put it in force as a table."""
    cleaned = CLEANERS[mode](raw, **options)
    check = (lambda rows: require_key(rows, SUMMARY_KEY)) if mode == "strict" else None
    if name:
        replace_table(cleaned, name, path, check)
    else:
        replace_path(cleaned, path, check)
    return read_path(spark, path)
