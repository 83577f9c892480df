"""Tables written so that the rows of one vendor are found without reading the others.

Rows are sorted by the column inside the partitions that they are in, which takes no shuffle. Parquet
then has narrow ranges of values per page and row group, and a Bloom filter of the column per row
group; Spark's reader skips what a filter on the column cannot match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from procurelens.sources import snapshots

#: Bytes of a row group: small enough that skipping one saves something, large enough to scan.
GROUP_BYTES = 16 << 20
#: Distinct values for which the Bloom filter of a row group is sized.
DISTINCT = 100_000


def write_clustered(df: DataFrame, path: str, column: str, group_bytes: int = GROUP_BYTES, distinct: int = DISTINCT) -> snapshots.Version:
    """Put the rows in force as a new version of a table, clustered by a column."""
    options = {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(distinct),
        "parquet.block.size": str(group_bytes),
    }
    return snapshots.replace(df.sortWithinPartitions(column), path, options=options)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(snapshots.resolve(spark, path))
