"""Repeated keys of a table whose keys are nearly all unique, without a shuffle of every key.

A plain ``groupBy(keys)`` sends each unique key through the shuffle only to find that it is alone.
Here a first pass fills, per task, two bits for each slot of a hash: seen once, seen more than once.
The words of bits of all tasks merge to one filter; a second pass keeps the rows whose slot was seen
more than once, few beside the true repeats, and those are grouped exactly.

The filter is sent to the tasks, so it has a bound in bytes; a table that would need more is grouped
plainly. It never loses a repeat: equal keys have equal slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots for each row: about one unique key in eight shares its slot by chance.
SLOTS_PER_ROW = 8
#: Most bytes of the filter's sent half (one bit per slot): enough for 500 million rows.
FILTER_BYTES = 512 << 20
#: Groups in which the words of the tasks are merged first.
FAN = 32


def slots_for(rows: int, most_bytes: int = FILTER_BYTES) -> int | None:
    """A power of two of slots; None if they would take more than ``most_bytes``."""
    slots = 1 << max(6, (SLOTS_PER_ROW * max(rows, 1) - 1).bit_length())
    return slots if slots // 8 <= most_bytes else None


def _seen(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(slots // 64, "uint64"), np.zeros(slots // 64, "uint64")
        for batch in batches:
            hashes, counts = np.unique(np.array(batch.column(0)) & (slots - 1), return_counts=True)
            word, bit = hashes >> 6, np.uint64(1) << (hashes & 63).astype("uint64")
            again = (counts > 1) | ((once[word] & bit) != 0)
            np.bitwise_or.at(more, word[again], bit[again])
            np.bitwise_or.at(once, word, bit)
        used = np.flatnonzero(once)
        for at in range(0, len(used), 1 << 16):
            some = used[at : at + (1 << 16)]
            columns = [pa.array(some), pa.array(once[some].view("int64")), pa.array(more[some].view("int64"))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "once", "more"])

    return run


def _merged(words: DataFrame, keys: list[str]) -> DataFrame:
    """Bits of the same word: seen more than once by one part, or by two of them."""
    start = F.struct(F.lit(0).cast("long").alias("once"), F.lit(0).cast("long").alias("more"))

    def both(a, b):
        more = a["more"].bitwiseOR(b["more"]).bitwiseOR(a["once"].bitwiseAND(b["once"]))
        return F.struct(a["once"].bitwiseOR(b["once"]).alias("once"), more.alias("more"))

    listed = words.groupBy(*keys).agg(F.collect_list(F.struct("once", "more")).alias("parts"))
    return listed.select(*keys, F.aggregate("parts", start, both).alias("m")).select(*keys, "m.*")


def repeat_filter(df: DataFrame, keys: list[str], slots: int) -> np.ndarray:
    """One bit per slot: whether more than one row has a key there."""
    found = df.select(F.xxhash64(*keys).alias("hash")).mapInArrow(_seen(slots), "word long, once long, more long")
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    words = _merged(_merged(found, ["part", "word"]), ["word"]).where("more <> 0")
    # At most ``slots / 64`` rows, which the caller has bounded.
    rows = words.select("word", "more").toArrow()
    bits = np.zeros(slots // 64, "int64")
    bits[rows["word"].to_numpy()] = rows["more"].to_numpy()
    return bits.view("uint64")


def _let_through(bits: np.ndarray, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.array(batch.column(batch.num_columns - 1)) & (slots - 1)
            good = (bits[slot >> 6] >> (slot & 63).astype("uint64")) & np.uint64(1)
            yield batch.filter(pa.array(good == 1)).select(range(batch.num_columns - 1))

    return run


def possible_repeats(df: DataFrame, keys: list[str], rows: int | None = None, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """The keys of the rows that may have a repeated one: all that do, and a few of the others."""
    given = df.select(*keys)
    slots = slots_for(df.count() if rows is None else rows, most_bytes)
    if slots is None:
        return given
    bits = repeat_filter(given, keys, slots)
    hashed = given.withColumn("#hash", F.xxhash64(*keys))
    return hashed.mapInArrow(_let_through(bits, slots), given.schema)


def repeated_keys(df: DataFrame, keys: list[str], rows: int | None = None, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """Keys with more than one row and their number of rows, as ``quality.duplicate_keys`` gives them.

    ``rows`` spares the count of the table where it is known, roughly at least.
    """
    some = possible_repeats(df, keys, rows, most_bytes)
    return some.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")
