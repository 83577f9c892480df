"""The vendor summary from stored partial sums, so that a new chunk costs a scan of that chunk alone.

Every sum of the summary can be merged: lines per purchase group, copies per price row, freight per
vendor and sales per pair are kept as sums per key with the number of rows beside them. A chunk of any
of the four tables is grouped once, and its sums are written as a part of a versioned table
(``sources.snapshots``); the commit that names the part puts all its tables in force together. The
summary groups the parts again, by then one row per key and part, and joins them as the full build
does. From ``COMPACT_AFTER`` parts on they are merged into one.

A part also holds one row per table in ``chunks``: the chunk's name, its rows and a mark of its sums.
A chunk that comes again, as after a restarted job, is recognised and adds nothing; one that comes
under a known name with other content is refused.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from procurelens.plans.build import write_summary
from procurelens.plans.summary import LINE_KEYS, join_purchases, join_summary
from procurelens.schemas import RAW_SCHEMAS
from procurelens.sources import files, snapshots

COMPACT_AFTER = 8
CHUNKS = "chunks"
CHUNK_SCHEMA = "chunk string, table string, rows long, mark string"


@dataclass(frozen=True)
class Partial:
    """How a raw table is summed: rows that count, keys, and sums (as the summary names them)."""

    keys: tuple[str, ...]
    sums: tuple[tuple[str, str], ...]
    where: str = "true"


#: Raw tables and their sums (the keys and measures of the summary).
PARTIALS = {
    "purchases": Partial(tuple(LINE_KEYS), (("quantity", "quantity"), ("dollars", "dollars")), "purchaseprice > 0"),
    "purchase_prices": Partial(("brand", "price", "volume"), ()),
    "vendor_invoice": Partial(("vendornumber",), (("freight", "freight_cost"),)),
    "sales": Partial(
        ("vendorno", "brand"),
        (
            ("salesquantity", "total_sales_quantity"), ("salesdollars", "total_sales_dollars"),
            ("salesprice", "total_sales_price"), ("excisetax", "total_excise_tax"),
        ),
    ),
}


class ChunkConflict(ValueError):
    """A chunk's name is known, but its content is another."""


def partial_sums(table: str, rows: DataFrame) -> DataFrame:
    """One row per key: its sums and the number of rows that they hold."""
    plan = PARTIALS[table]
    sums = [F.sum(given).alias(name) for given, name in plan.sums]
    return rows.where(plan.where).groupBy(*plan.keys).agg(F.count("*").alias("rows"), *sums)


def merged(table: str, parts: DataFrame) -> DataFrame:
    """Partial sums of several chunks as those of all; types stay as they are."""
    plan = PARTIALS[table]
    sums = [F.sum(name).cast(parts.schema[name].dataType).alias(name) for name in ("rows", *[n for _, n in plan.sums])]
    return parts.groupBy(*plan.keys).agg(*sums)


def _mark(columns: list[str]) -> Column:
    """The content of partial sums, whatever their order: a sum of hashes, as text."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string")


def _folders(spark: SparkSession, path: str) -> list[str]:
    version = snapshots.current(spark, path)
    return snapshots.folders(path, version) if version else []


def known_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, table, rows, mark) of all chunks in force; ``rows`` counts those that the sums hold."""
    found = [f"{f}/{CHUNKS}" for f in _folders(spark, path)]
    return spark.read.schema(CHUNK_SCHEMA).parquet(*found) if found else spark.createDataFrame([], CHUNK_SCHEMA)


def add_chunk(
    spark: SparkSession, path: str, chunk: str, tables: Mapping[str, DataFrame], compact_after: int = COMPACT_AFTER
) -> dict[str, str]:
    """Add a chunk of one or more raw tables; returns what became of each: ``added`` or ``known``.

    All tables of a chunk come into force together or, when anything fails, not at all.
    """
    base = snapshots.current(spark, path)
    # One name's rows only: four at most.
    before = {r.table: (r.rows, r.mark) for r in known_chunks(spark, path).where(F.col("chunk") == chunk).collect()}
    part = snapshots.new_part()
    folder = f"{path.rstrip('/')}/{snapshots.VERSIONS}/{part}"
    try:
        told = _write_part(spark, folder, chunk, tables, before)
    except Exception:
        files.delete(spark, folder)
        raise
    if told:
        version = snapshots.commit(spark, path, [*(base.parts if base else ()), part], base)
        if len(version.parts) >= compact_after:
            compact(spark, path)
    else:
        files.delete(spark, folder)
    return {t: "added" if t in told else "known" for t in PARTIALS if t in tables}


def _write_part(
    spark: SparkSession, folder: str, chunk: str, tables: Mapping[str, DataFrame], before: Mapping[str, tuple]
) -> set[str]:
    """Write the sums of a chunk below a folder, and its row in ``chunks``; returns the tables that are new."""
    told = []
    for table in PARTIALS:
        schema, place = _schema(spark, table), f"{folder}/{table}"
        if table in tables:
            partial_sums(table, tables[table]).write.parquet(place)
            mine = tuple(spark.read.schema(schema).parquet(place).agg(F.coalesce(F.sum("rows"), F.lit(0)), _mark(schema.names)).first())
            if table not in before:
                told.append((chunk, table, *mine))
                continue
            if before[table] != mine:
                raise ChunkConflict(f"chunk {chunk} of {table} was added before with other content")
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(place)
    spark.createDataFrame(told, CHUNK_SCHEMA).coalesce(1).write.parquet(f"{folder}/{CHUNKS}")
    return {table for _, table, *_ in told}


def _schema(spark: SparkSession, table: str) -> StructType:
    return partial_sums(table, spark.createDataFrame([], RAW_SCHEMAS[table])).schema


def sums_of(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The sums of a raw table over all chunks in force."""
    found = [f"{f}/{table}" for f in _folders(spark, path)]
    schema = _schema(spark, table)
    parts = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return merged(table, parts) if len(found) > 1 else parts


def compact(spark: SparkSession, path: str) -> snapshots.Version:
    """Merge all parts into one; what the summary says stays the same."""
    base, part = snapshots.current(spark, path), snapshots.new_part()
    folder = f"{path.rstrip('/')}/{snapshots.VERSIONS}/{part}"
    for table in PARTIALS:
        sums_of(spark, path, table).write.parquet(f"{folder}/{table}")
    known_chunks(spark, path).coalesce(1).write.parquet(f"{folder}/{CHUNKS}")
    return snapshots.commit(spark, path, [part], base, notes={"compacted": len(base.parts) if base else 0})


def incremental_summary(spark: SparkSession, path: str, ordered: bool = True) -> DataFrame:
    """The vendor summary over all chunks in force, from the stored sums."""
    sums = {t: sums_of(spark, path, t) for t in PARTIALS}
    bought = join_purchases(
        sums["purchases"].drop("rows"),
        sums["purchase_prices"].withColumnsRenamed({"price": "actual_price", "rows": "copies"}),
    )
    return join_summary(
        bought, sums["sales"].drop("rows").withColumnRenamed("vendorno", "vendornumber"), sums["vendor_invoice"].drop("rows"), ordered
    )


def build_incremental(spark: SparkSession, path: str, target: str, mode: str = "lenient", name: str | None = None, **options) -> DataFrame:
    """The build job (``plans.build``) on the stored sums instead of the raw tables."""
    return write_summary(spark, incremental_summary(spark, path, ordered=False), target, mode, name, **options)


def add_in_chunks(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], chunks: int) -> None:
    """Add whole tables as several chunks of about equal size, dealt by the hash of a row."""
    for i in range(chunks):
        mine = {t: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(chunks)) == i) for t, df in tables.items()}
        add_chunk(spark, path, f"chunk-{i}", mine)

