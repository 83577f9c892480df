"""Table scans and full-replace sinks.

Replaced tables are versioned (``snapshots``): the new rows are complete before they count, so a job
that fails in the middle leaves the old ones readable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from procurelens.session import work_dir
from procurelens.sources import snapshots


def read_table(spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
    """A catalog table, or the part of it that a condition selects."""
    df = spark.table(name)
    return df.where(where) if where else df


def read_path(spark: SparkSession, path: str, where: str | None = None, version: int | None = None) -> DataFrame:
    """A Parquet folder; of a versioned table the version in force, or a kept one by its number."""
    df = spark.read.parquet(snapshots.resolve(spark, path, version))
    return df.where(where) if where else df


def replace_path(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None) -> snapshots.Version:
    """Put the rows in place of whatever the folder held; ``check`` may refuse them before that."""
    return snapshots.replace(df, path, check)


def replace_table(
    df: DataFrame, name: str, path: str | None = None, check: Callable[[DataFrame], None] | None = None
) -> snapshots.Version:
    """Put the rows in place of a catalog table's.

    The name is a view of the version in force, swapped in one step of the catalog. The data lies in
    ``path``, by default a folder of the warehouse. A table of that name from elsewhere goes once the
    new rows are complete.
    """
    spark = df.sparkSession
    if path is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or work_dir(spark, "warehouse")
        path = f"{warehouse.rstrip('/')}/{name.replace('`', '')}"
    version = replace_path(df, path, check)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    folder = snapshots.folders(path, version)[0].replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return version
