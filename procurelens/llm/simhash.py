"""SimHash near-duplicates by deletion variants.

A fingerprint has 64 bits. Cut into three segments, two fingerprints that differ in at most
five bits differ in at most one bit in some segment. So each fingerprint is indexed under every
segment with one bit wiped out, 64 variants in all; fingerprints that share a variant are
candidates, and only those are compared bit by bit.

Documents with one fingerprint are one entry of the index. Rows of a variant meet in a sorted
sweep that holds one variant at a time and returns a spanning forest of the links, never all
pairs. A variant with more than ``cap`` fingerprints is put off: its members are dealt into
blocks, and every two blocks meet in a task of their own. All of them are compared, none is
dropped. Links become components by ``connected_components``.

Defined cases: a null or empty text has no shingle and the fingerprint zero, which links like
any other; a text with fewer words than a shingle is one shingle; repeated shingles count
again; ids that are null give a null component only if no other id is reachable; repeated rows
get the same answer; an empty table gives an empty result; extra columns are ignored by
``near_groups`` and kept by ``drop_near_copies``, which numbers the rows and keeps one of a component:
of its smallest id, null last, the text and then the row that come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import fresh, numbered, saved, table, tidy
from procurelens.llm.components import connected_components

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
#: The three segments of a fingerprint: first bit and width.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Fingerprints of one variant that are compared in one task.
CAP = 20_000
_LANES = np.uint64(0x0101010101010101)
_BITS = np.array([8 * lane + bit for bit in range(8) for lane in range(8)])


def shingle_hashes(text: str, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every run of ``width`` words, lower-cased in ASCII and joined by one space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "uint64")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], dtype="uint64")
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-width] + 1]).tolist()
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype="uint64")


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes; counted in eight byte lanes at a time."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, "int64")
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & _LANES
        pad = -n % 255
        if pad:
            lanes = np.concatenate([lanes, np.zeros(pad, "uint64")])
        packed = lanes.reshape(-1, 255).sum(axis=1, dtype="uint64")
        ones[8 * bit : 8 * bit + 8] = packed.view("uint8").reshape(-1, 8).sum(axis=0, dtype="int64")
    found = 0
    for where in np.flatnonzero(2 * ones > n).tolist():
        found |= 1 << int(_BITS[where])
    return found


def _fingerprints(width: int):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t or "", width)) for t in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "fp": np.array(prints, dtype="uint64").view("int64")}
            )

    return run


def document_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(_fingerprints(width), "doc_id long, fp long")


def deletion_variants(prints: DataFrame) -> DataFrame:
    """(wiped, variant, fp): each fingerprint under its segments with one bit wiped out."""
    variants = []
    for first, width in SEGMENTS:
        segment = ((1 << width) - 1) << first
        for bit in range(first, first + width):
            mask = segment & ~(1 << bit)
            mask -= (mask >> 63) << 64
            variants.append(f"named_struct('wiped', {bit}, 'variant', fp & {mask}L)")
    listed = prints.selectExpr("fp", f"explode(array({', '.join(variants)})) AS v")
    return listed.selectExpr("v.wiped AS wiped", "v.variant AS variant", "fp")


def linked_to_pivots(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links between distinct fingerprints.

    Grows a component from each member in turn and compares only with those not yet reached.
    """
    rest, forest = np.arange(len(prints)), []
    while len(rest):
        frontier, rest = [int(rest[0])], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(prints[rest] ^ prints[at]) <= most
            reached = rest[near].tolist()
            forest += [(at, i) for i in reached]
            frontier += reached
            rest = rest[~near]
    return forest


def _sweep(most: int, cap: int, keys: list[str]):
    """Links inside every key of sorted rows; keys with more than ``cap`` members come back whole."""
    def links(fp: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        pairs = []
        two = stops - starts == 2
        first = starts[two]
        near = np.bitwise_count(fp[first] ^ fp[first + 1]) <= most
        pairs.append(np.stack([fp[first[near]], fp[first[near] + 1]], axis=1))
        for s, e in zip(starts[stops - starts > 2].tolist(), stops[stops - starts > 2].tolist(), strict=True):
            part = fp[s:e]
            forest = linked_to_pivots(part, most)
            if forest:
                pairs.append(part[np.array(forest)])
        return np.concatenate(pairs)

    def frame(pairs: np.ndarray) -> pd.DataFrame:
        pairs = np.unique(np.sort(pairs.view("int64"), axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "wiped": -1, "variant": 0})

    def late(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": rows["fp"], "b": rows["fp"], "wiped": rows["wiped"], "variant": rows["variant"]})

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last key so far, which the next batch may go on with
        over, last = False, None
        for batch in batches:
            if not len(batch):
                continue
            ids = batch[keys].to_numpy()
            change = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            same = last is not None and (ids[0] == last).all()
            last = ids[-1]
            if same and not len(change):
                if over:
                    yield late(batch)
                    continue
                held.append(batch)
                if sum(map(len, held)) > cap:
                    over = True
                    yield late(pd.concat(held))
                    held = []
                continue
            if same and over:
                yield late(batch.iloc[: change[0]])
                batch = batch.iloc[change[0] :]
            rows = pd.concat([*held, batch]) if held else batch
            over = False
            ids = rows[keys].to_numpy()
            edges = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], edges])
            stops, held = starts[1:], [rows.iloc[starts[-1] :]]
            starts = starts[:-1]
            big = stops - starts > cap
            for s, e in zip(starts[big].tolist(), stops[big].tolist(), strict=True):
                yield late(rows.iloc[s:e])
            some = ~big & (stops - starts > 1)
            if some.any():
                yield frame(links(rows["fp"].to_numpy().view("uint64"), starts[some], stops[some]))
        rows = pd.concat(held) if held else []
        if len(rows) > cap:
            yield late(rows)
        elif len(rows) > 1:
            yield frame(links(rows["fp"].to_numpy().view("uint64"), np.array([0]), np.array([len(rows)])))

    return run


_FOUND = "a long, b long, wiped int, variant long"


def fingerprint_links(spark: SparkSession, prints: DataFrame, most: int = MOST_BITS, cap: int = CAP) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at ``most`` bits or fewer."""
    if most >= 2 * len(SEGMENTS):
        raise ValueError("three segments find pairs of at most five differing bits")
    index = deletion_variants(prints).repartition("wiped", "variant").sortWithinPartitions("wiped", "variant")
    found = saved(spark, index.mapInPandas(_sweep(most, cap, ["wiped", "variant"]), _FOUND), "found")
    late = found.where("wiped >= 0").select("wiped", "variant", F.col("a").alias("fp"))
    blocks = late.groupBy("wiped", "variant").agg(F.ceil(F.count("*") / (cap // 4)).cast("int").alias("blocks"))
    dealt = late.join(blocks, ["wiped", "variant"]).withColumn("own", F.expr("pmod(xxhash64(fp), blocks)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1L)")))
    dealt = dealt.selectExpr("wiped", "variant", "least(own, other) AS low", "greatest(own, other) AS high", "fp")
    keys = ["wiped", "variant", "low", "high"]
    met = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_sweep(most, 1 << 62, keys), _FOUND)
    return found.where("wiped < 0").select("a", "b").unionByName(met.select("a", "b")).distinct()


def component_roots(spark: SparkSession, distinct: DataFrame, most: int = MOST_BITS, cap: int = CAP) -> DataFrame:
    """``distinct`` with ``root``, the fingerprint that names the component of ``fp``."""
    roots = connected_components(spark, fingerprint_links(spark, distinct.select("fp"), most, cap))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rooted.withColumn("root", F.coalesce("root", "fp"))


def near_groups(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = SHINGLE_WORDS, most: int = MOST_BITS, cap: int = CAP,
) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    prints = saved(spark, document_fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = saved(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    rooted = component_roots(spark, distinct, most, cap)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(answer, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = SHINGLE_WORDS, most: int = MOST_BITS,
) -> DataFrame:
    """One document of each component, with its smallest id."""
    columns = docs.columns
    docs, row = numbered(spark, docs, "simhash_rows")
    prints = document_fingerprints(docs, row, text_col, width).select(F.col("doc_id").alias("row"), "fp")
    ids = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"))
    firsts = prints.join(ids, "row").groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "row")).alias("first")
    )
    rooted = component_roots(spark, saved(spark, firsts, "distinct"), most)
    key = fresh(docs, "_kept")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(key))
    return docs.join(kept, F.col(row) == F.col(key), "left_semi").select(*columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark, table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
