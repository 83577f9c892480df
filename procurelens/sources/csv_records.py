"""Records of CSV files with line breaks inside quotes, read in parallel over byte ranges of a file.

Spark's text reader splits a file into ranges and gives whole lines, but a line break inside quotes
does not end a record. Whether a line begins inside quotes is the parity of the quote marks before
it, and parities of ranges can be counted apart:

1. One pass counts the quote marks of every range (a sum per range, one small row each). The running
   parity over a file's ranges, in order, says where each range begins.
2. In a second pass each task walks over its lines with that start and joins those between two
   odd ones. What lies before a range's first record, and the record that its end cuts, come out as
   fragments, two per range at most; they meet by file in a window over ranges and one grouping.

The marks must follow the rules of the format: quotes around a field, doubled inside. Other records
are found by their text and carry a reason instead of becoming rows, as do those with more fields
than the header; missing fields at the end are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A record whose quotes follow the rules (fixed by the format).
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
WELL_QUOTED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"
_QUOTED = r'(?s)"(?:[^"]++|"")*+"'
_SCHEMA = "file string, block long, nth long, kind string, text string"
#: The column that says where a record is, its text and why it is no row; no cleaned name holds such a mark.
ABOUT = "#record"
#: Parts of a record that crosses the end of a range: its start, and what a later range adds.
WHOLE, START, REST = "whole", "start", "rest"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, text, marks): every line, the first byte of its range, and how many quote marks it holds."""
    text = F.col("value")
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        text.alias("text"),
        (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))).alias("marks"),
    )


def range_parities(found: DataFrame) -> DataFrame:
    """(file, block, odd, any_odd): the parity of the marks before each range, and whether one of its lines is odd."""
    sums = found.groupBy("file", "block").agg(F.sum("marks").alias("marks"), F.max(F.col("marks") % 2).alias("any_odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2
    return sums.select("file", "block", odd.cast("int").alias("odd"), (F.col("any_odd") > 0).alias("any_odd"))


class _Range:
    """Joins the lines of one range to records, batch by batch."""

    def __init__(self, file: str, block: int, odd: bool):
        self.file, self.block, self.nth = file, block, 0
        self.odd, self.open, self.kind = odd, [], REST if odd else START

    def _row(self, text: str, kind: str) -> tuple:
        self.nth += 1
        return self.file, self.block, self.nth - 1, kind, text

    def add(self, texts: list[str], odd_lines: np.ndarray) -> list[tuple]:
        out, at = [], 0
        for i in [*np.flatnonzero(odd_lines).tolist(), len(texts)]:
            # Lines before the next odd one keep the state.
            if self.odd:
                self.open += texts[at:i]
            else:
                out += [self._row(t, WHOLE) for t in texts[at:i]]
            if i < len(texts):
                self.open.append(texts[i])
                if self.odd:
                    out.append(self._row("\n".join(self.open), self.kind if self.kind == REST else WHOLE))
                    self.open, self.kind = [], START
                self.odd = not self.odd
            at = i + 1
        return out

    def close(self) -> list[tuple]:
        """The record that the end of the range cuts; all of it continues what an earlier range began if ``kind`` is REST."""
        return [self._row("\n".join(self.open), self.kind + "-open")] if self.open else []


def _assemble(starts: dict[tuple[str, int], int]):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "nth", "kind", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Range | None = None
        for batch in batches:
            files, blocks = batch.column(0).to_pylist(), np.array(batch.column(1))
            odd, texts = np.array(batch.column(3)) % 2 == 1, batch.column(2).to_pylist()
            edges = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]) | np.array([a != b for a, b in zip(files, files[1:], strict=False)], bool)) + 1).tolist(), len(texts)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                key = (files[a], int(blocks[a]))
                if now is None or (now.file, now.block) != key:
                    if now and (rows := now.close()):
                        yield batch_of(rows)
                    if key not in starts:
                        raise RuntimeError(f"the ranges of {key[0]} changed between the passes")
                    now = _Range(*key, bool(starts[key]))
                if rows := now.add(texts[a:b], odd[a:b]):
                    yield batch_of(rows)
        if now and (rows := now.close()):
            yield batch_of(rows)

    return run


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records that cross the ends of ranges: a start and the rests of the ranges after it."""
    order = Window.partitionBy("file").orderBy("block", "nth")
    at = F.when(F.col("kind") == f"{START}-open", F.struct("block", "nth"))
    owned = pieces.withColumn("owner", F.last(at, ignorenulls=True).over(order))
    texts = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    joined = F.array_join(F.transform(texts, lambda x: x["text"]), "\n")
    return owned.groupBy("file", "owner").agg(joined.alias("text")).select("file", "owner.block", "owner.nth", "text")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, nth, text): every record, with the range and the place in it where it begins.

    Blank records are left out. Where no line has an odd number of marks, lines are records and no
    task joins any.
    """
    found = lines(spark, path)
    # One small row per byte range of the path: 8,000 for a terabyte.
    ranges = range_parities(found).collect()
    starts = {(r.file, r.block): r.odd for r in ranges}
    rows = found.mapInArrow(_assemble(starts), _SCHEMA)
    whole = rows.where(F.col("kind") == WHOLE).drop("kind")
    if any(r.any_odd for r in ranges):
        whole = whole.unionByName(_stitched(rows.where(F.col("kind") != WHOLE)))
    return whole.withColumn("text", F.regexp_replace("text", r"\A\uFEFF|\r\z", "")).where("trim(text) <> ''")


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line of the path has an odd number of quote marks, as only records of several lines should."""
    return not lines(spark, path).where("marks % 2 = 1").isEmpty()


def field_count(text: Column) -> Column:
    plain = F.regexp_replace(text, _QUOTED, "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def split_header(found: DataFrame) -> tuple[list[str], DataFrame]:
    """The header of the files, which must be the same in all, and the other records."""
    first = (F.col("block") == 0) & (F.col("nth") == 0)
    heads = [r.text for r in found.where(first).select("text").distinct().limit(2).collect()]
    if not heads:
        return [], found
    if len(heads) > 1:
        raise ValueError(f"the files have different headers: {heads[0]!r} and {heads[1]!r}")
    names = _parse_line(found.sparkSession, heads[0])
    return names, found.where(~first)


def _parse_line(spark: SparkSession, text: str) -> list[str]:
    n = spark.range(1).select(field_count(F.lit(text))).first()[0]
    row = spark.range(1).select(_fields(F.lit(text), n).alias("x")).first().x
    return [v or "" for v in row]


def _fields(text: Column, n: int) -> Column:
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(n)])
    return F.from_csv(text, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})


def parsed(found: DataFrame, names: list[str]) -> DataFrame:
    """``ABOUT`` of each record (file, block, nth, text, reason) and a text column per name.

    ``reason`` says why a record is no row, and is NULL for others.
    """
    quoted = F.instr("text", '"') > 0
    n = F.when(quoted, field_count(F.col("text"))).otherwise(F.length("text") - F.length(F.replace("text", F.lit(","), F.lit(""))) + 1)
    reason = F.when(quoted & ~F.col("text").rlike(WELL_QUOTED), "quote marks inside a field").when(
        n > len(names), F.concat(n.cast("string"), F.lit(f" fields instead of {len(names)}"))
    )
    about = F.struct("file", "block", "nth", "text", "reason").alias(ABOUT)
    rows = found.withColumn("reason", reason)
    rows = rows.select(about, F.when(F.col("reason").isNull(), _fields(F.col("text"), len(names))).alias("fields"))
    return rows.select(F.col(f"`{ABOUT}`"), *[F.col(f"fields._{i}").alias(name) for i, name in enumerate(names)])
