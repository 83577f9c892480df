"""Load a folder of CSV part files chunk by chunk, for sources too large for one pass.

The first chunk replaces the table and the others add to it. Each chunk has its own
partition, which a repeated chunk overwrites, so a load that is restarted from its checkpoint
after a lost driver neither loses nor repeats rows.
"""

from __future__ import annotations

import time
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procurelens.session import work_dir
from procurelens.sources.csv_folder import AUDIT_SCHEMA, CSV_OPTIONS, UnusableFile, exact_cast, present
from procurelens.sources.naming import clean_names

CHUNK = "chunk"
#: Chunks of one load. Each is a commit of its own, whose cost does not depend on its rows, so a source with
#: more files than fit in so many chunks gets larger ones.
MOST_CHUNKS = 64


def load_in_chunks(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    files_per_chunk: int = 8,
    checkpoint: str | None = None,
    most_chunks: int = MOST_CHUNKS,
) -> DataFrame:
    """Load what the folder holds now and return the table, with the columns of the schema.

    A chunk is ``files_per_chunk`` files, or as many more as it takes to have ``most_chunks`` chunks at most.

    Columns are matched by their cleaned names, all parts have the same header, and values are
    cast strictly. A folder without CSV gives an empty table. Pass the checkpoint of an
    interrupted load to go on with it; a new one starts the table over. One audit row, with the
    rows of the whole table, is written to ``target/_load_audit``.
    """
    start, wanted = time.time(), [f.name for f in schema.fields]
    files = len(spark.read.format("binaryFile").load(source).inputFiles())
    if not files:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(target)
        return _audited(spark, spark.read.schema(schema).parquet(target), source, target, start)
    header = spark.read.options(**CSV_OPTIONS).csv(source).columns
    cleaned = clean_names(header)
    absent = [name for name in wanted if name not in cleaned]
    if absent:
        raise UnusableFile(f"the parts lack the columns {absent}")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.readStream.schema(texts).options(**CSV_OPTIONS).option("maxFilesPerTrigger", max(files_per_chunk, ceil(files / most_chunks)))
    given = reader.csv(source).toDF(*cleaned).select(*[present(name).alias(name) for name in wanted])
    typed = given.select(*[exact_cast(f.name, f.dataType).alias(f.name) for f in schema.fields])
    part = CHUNK
    while part in wanted:
        part += "_"

    def write(chunk: DataFrame, number: int) -> None:
        (
            chunk.withColumn(part, F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if number == 0 else "dynamic")
            .partitionBy(part)
            .parquet(target)
        )

    query = (
        typed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or work_dir(spark, "csv-chunks"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = T.StructType([*schema.fields, T.StructField(part, T.LongType())])
    return _audited(spark, spark.read.schema(stored).parquet(target).drop(part), source, target, start)


def _audited(spark: SparkSession, loaded: DataFrame, source: str, target: str, start: float) -> DataFrame:
    names = [x.rstrip("/").split("/")[-1] for x in (source, target)]
    row = (*names, loaded.count(), 0, "loaded", None, None, time.time() - start)
    spark.createDataFrame([row], AUDIT_SCHEMA).write.mode("overwrite").parquet(f"{target.rstrip('/')}/_load_audit")
    return loaded
