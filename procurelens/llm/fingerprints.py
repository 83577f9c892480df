"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs. Each paragraph is hashed to a wide vector: ``WORDS``
full 64-bit numbers and ``LANES`` entries of +1 and -1. A fingerprint is the sum of the vectors, the
numbers modulo 2**64 and the lanes as signed sums (written modulo 2**32, which two thousand million
equal paragraphs would take to go round). The order of the paragraphs does not matter, and a paragraph
is inserted or deleted by adding or subtracting its vector: the fingerprint of an edited document is
that of the original, less the paragraphs that went, plus those that came. The numbers tell different
multisets apart, however often a paragraph repeats. The entries of the lanes are small, so the squared
length of the difference of two fingerprints there estimates how many paragraphs are in one and not
the other, which gives a likeness.

A paragraph here is a sentence-like stretch that ends at a line end or after . ! or ?, trimmed,
and cut every ``PARAGRAPH_WORDS`` words, so that texts of one long line still have several.

Each document meets the next one in one shuffle of the texts: documents are dealt into ranges of
ids, the first document of a range is also sent to the range before it, and tasks read their
ranges in id order, holding two texts at a time. What is broadcast are the first ids of the
ranges, whose number is a multiple of the shuffle partitions.

Defined cases: a null text counts as empty; null ids come after all others; rows that repeat an
id follow each other in the order of their texts; a single document is its own next; an empty
text has the zero fingerprint; two zero fingerprints are alike (1), one of them is not (0); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procurelens.llm.common import table, tidy

#: Numbers of 64 bits of a fingerprint, and signed sums after them.
WORDS, LANES = 8, 256
#: Paragraphs that are hashed at a time.
STEP = 4096
PARAGRAPH_WORDS = 16
#: Rows of one answer of a task: the two fingerprints of a row are 4 kB of text.
ROWS = 256
#: Ranges of ids for each shuffle partition, and quantiles that bound them.
RANGES_EACH, QUANTILES = 8, 64
_STRETCH = re.compile(r"[^.!?\n]*[.!?\n]*")


def paragraphs(text: str) -> list[str]:
    found = []
    for stretch in _STRETCH.findall(text):
        words = stretch.split()
        found += [" ".join(words[i : i + PARAGRAPH_WORDS]) for i in range(0, len(words), PARAGRAPH_WORDS)]
    return found


class Vectors(NamedTuple):
    """One row per paragraph: its numbers, and its entries of +1 and -1."""

    numbers: np.ndarray
    signs: np.ndarray

    def after(self, start: int) -> Vectors:
        return Vectors(self.numbers[start:], self.signs[start:])


def vectors(parts: list[str]) -> Vectors:
    numbers, signs = np.empty((len(parts), WORDS), "uint64"), np.empty((len(parts), LANES), "int8")
    for at in range(0, len(parts), STEP):
        some = parts[at : at + STEP]
        digests = b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=8 * WORDS).digest() for p in some)
        numbers[at : at + STEP] = np.frombuffer(digests, "<u8").reshape(-1, WORDS)
        bits = np.frombuffer(digests, "uint8").reshape(-1, 8 * WORDS)[:, : LANES // 8]
        signs[at : at + STEP] = 2 * np.unpackbits(bits, axis=1).astype("int8") - 1
    return Vectors(numbers, signs)


def added(rows: Vectors) -> np.ndarray:
    """The sum of vectors: numbers modulo 2**64, then signed sums as two's complements."""
    return np.concatenate([rows.numbers.sum(axis=0, dtype="uint64"), rows.signs.sum(axis=0, dtype="int64").view("uint64")])


def insert(fingerprint: np.ndarray, parts: list[str]) -> np.ndarray:
    return fingerprint + added(vectors(parts))


def delete(fingerprint: np.ndarray, parts: list[str]) -> np.ndarray:
    return fingerprint - added(vectors(parts))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal fingerprints, about the shared part of the paragraphs otherwise."""
    if (a == b).all():
        return 1.0
    length = lambda v: float((v[WORDS:].view("int64").astype("float64") ** 2).sum())
    if not length(a) + length(b):
        return 0.0
    return min(1.0, max(0.0, 1 - length(a - b) / (length(a) + length(b))))


def as_text(fingerprint: np.ndarray) -> str:
    return (fingerprint[:WORDS].astype("<u8").tobytes() + fingerprint[WORDS:].astype("<u4").tobytes()).hex()


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _answers(columns: list[str]):
    def fingerprinted(text: str) -> tuple[list[str], Vectors, np.ndarray]:
        parts = paragraphs(text)
        rows = vectors(parts)
        return parts, rows, added(rows)

    def answer(doc_id, text: str, mine, following: str, theirs) -> tuple:
        parts, rows, own = mine
        edited = edited_text(text, following)
        changed = paragraphs(edited)
        same = next((i for i, (a, b) in enumerate(zip(parts, changed, strict=False)) if a != b), min(len(parts), len(changed)))
        moved = own - added(rows.after(same)) + added(vectors(changed[same:]))
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, as_text(own), as_text(moved), likeness(own, moved), likeness(own, theirs[2])

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # the last document of the range so far: (range, id, text, fingerprint)
        wanted = ["range", "borrowed", "doc_id", "text"]
        for few in (batch[wanted].iloc[at : at + ROWS] for batch in batches for at in range(0, len(batch), ROWS)):
            out = []
            for within, borrowed, doc_id, text in few.itertuples(index=False):
                if borrowed and (before is None or before[0] != within):
                    continue  # a further row with the id of the next range's first document
                mine = fingerprinted(text)
                if before is not None and before[0] == within:
                    out.append(answer(before[1], before[2], before[3], text, mine))
                before = None if borrowed else (within, doc_id, text, mine)
            frame = pd.DataFrame(out, columns=columns)
            yield frame.astype({"doc_id": "Int64"})

    return run


def _range_of(id_col: Column, cuts: list[int], each: int) -> Column:
    """The range of an id: a tree of comparisons with the quantiles, then equal widths between them."""
    def tree(low: int, high: int) -> Column:
        if high - low == 1:
            first, width = cuts[low], max(cuts[high] - cuts[low], 1)
            inner = F.floor((id_col.cast("double") - F.lit(float(first))) / F.lit(float(width)) * each)
            return F.greatest(F.lit(0), F.least(F.lit(each - 1), inner)).cast("long") + low * each
        middle = (low + high) // 2
        return F.when(id_col < F.lit(cuts[middle]), tree(low, middle)).otherwise(tree(middle, high))

    null_range = F.lit((len(cuts) - 1) * each).cast("long")
    return F.when(id_col.isNull(), null_range).otherwise(tree(0, len(cuts) - 1))


def with_next_document(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents sorted inside ranges of ids, each range ending with a borrowed copy of the next range's first."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    ids = texts.select("doc_id")
    found = ids.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 0.002)
    cuts = sorted({int(x) for x in found}) or [0]
    cuts = cuts if len(cuts) > 1 else [cuts[0], cuts[0] + 1]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    within = _range_of(F.col("doc_id"), cuts, max(1, -(-RANGES_EACH * parts // (len(cuts) - 1))))
    ranges = ids.groupBy(within.alias("range")).agg(F.min("doc_id").alias("first_id"))
    in_order = W.orderBy("range")
    last = F.max("range").over(W.partitionBy())
    lent = ranges.select(F.coalesce(F.lag("range").over(in_order), last).alias("lent_to"), "first_id")
    borrowed = texts.join(F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("first_id")))
    rows = texts.select(within.alias("range"), F.lit(False).alias("borrowed"), "doc_id", "text").unionByName(
        borrowed.select(F.col("lent_to").alias("range"), F.lit(True).alias("borrowed"), "doc_id", "text")
    )
    order = ["range", "borrowed", F.col("doc_id").asc_nulls_last(), "text"]
    # Ranges go round by number, so that every task has as many of them.
    return rows.repartitionById(parts, F.pmod("range", F.lit(parts)).cast("int")).sortWithinPartitions(*order)


def fingerprint_table(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    columns = [c.split()[0] for c in schema.split(",")]
    return with_next_document(spark, docs, id_col, text_col).mapInPandas(_answers(columns), schema)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_table(spark, table(spark, sf_dir, "documents"))
