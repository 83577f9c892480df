"""Repeated byte strings by merging the Burrows-Wheeler transforms of shards.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere else. Each such
string (a window) belongs to one anchor: the leftmost smallest of the hashes of its ``GRAM``-byte
strings. Equal windows have equal anchors at equal distance, so windows only need comparing
inside the group of an anchor hash; the groups spread over the cluster and lose no repeat.

1. Every document gives its anchors: hash, first and last window, and a hash of all the bytes
   that these windows span (the context).
2. Contexts that occur again are repeats as they stand; counts combine on the map side, so
   thousands of copies of a text become one row each. Anchors that occur once are done.
3. What is left are contexts that differ somewhere, with one member for each repeated context.
   Tasks gather whole groups into batches, cut a batch into shards, sort the suffixes of each
   shard, and keep its Burrows-Wheeler transform. The transforms are merged by refining their
   interleave: starting from the shards one after another, each pass deals the merged transform
   stably by symbol, which sorts all suffixes by one symbol more. Where a pass first separates
   two neighbours is their common prefix; runs that the last pass leaves together are repeated
   intervals. No suffix is sorted again. Symbols that occur once in a batch, and chains of too few
   others, are left out before, as no window over them can be repeated. A symbol is a string of
   ``STRIDE`` bytes, and the predecessor of a suffix the one that starts ``STRIDE`` bytes before,
   so ``LENGTH / STRIDE`` passes reach the full depth.
4. Covered stretches meet their text again, and are cut out.

The contexts of a group of more than ``CAP`` get anchors again, by longer strings (``anchor_grams``),
and go through steps 1 and 2 with those. The last string is the window itself, which leaves no
group of differing contexts, so no group grows with the input and no two blocks of one have to meet.
Strings are compared by 64-bit hashes of their symbols, eight in a row for a window.

Defined cases: a null text is empty; matches never cross documents, and may overlap inside one;
rows that repeat id and text are separate places, so each covers the other; ids may be null; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import saved, table

LENGTH = 400
GRAM = 64
STRIDE = 50
CAP = 2000
#: Window starts of one block of a text, bytes of a batch and of a shard.
BLOCK, BATCH_BYTES, SHARD_BYTES = 1 << 20, 1 << 20, 1 << 18
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype="uint64")
_POSITION = np.uint64((1 << 21) - 1)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            table_ = np.full(n, base, "uint64")
            table_[0] = 1
            _powers[name] = np.multiply.accumulate(table_)
    return _powers["up"], _powers["down"]


class Rolling:
    """Hashes of all substrings of one length, from running sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, "uint64")
        np.cumsum(_TABLE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.down[starts])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Rows (anchor hash, context hash, first window, last window) that share out all windows of a text."""
    found = []
    for start in range(0, len(data) - length + 1, BLOCK):
        part = data[start : start + BLOCK + length - 1]
        rolling = Rolling(part)
        hashes = rolling.all(gram)
        marked = (hashes & ~_POSITION) | np.arange(len(hashes), dtype="uint64")
        anchor = (sliding_least(marked, length - gram + 1) & _POSITION).astype("int64")
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        own = anchor[first]
        shape = ((own - first) * 4096 + (last - first)).astype("uint64")
        context = mixed(rolling.of(first, last + length) + shape * np.uint64(_ODD))
        found.append(np.stack([hashes[own].view("int64"), context.view("int64"), first + start, last + start], axis=1))
    return found


def anchor_grams(length: int, gram: int) -> list[int]:
    """Lengths of the strings that make anchors, for the texts and then for groups that are too large."""
    return sorted({gram, length - (length - gram) // 2, length - (length - gram) // 8, length})


def _bytes(text: str | bytes | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass") if not isinstance(text, bytes) else text
    return np.frombuffer(data, "uint8")


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                found = [anchors_of(_bytes(t), length, gram) for t in part["data"]]
                counts = [sum(map(len, f)) for f in found]
                rows = [x for f in found for x in f]
                if not rows:
                    continue
                rows = np.concatenate(rows)
                frame = pd.DataFrame(rows, columns=["anchor", "context", "first", "last"])
                begin = part["first"].repeat(counts).to_numpy()
                frame["first"] += begin
                frame["last"] += begin
                frame["base"] = begin
                frame["alone"] = part["alone"].repeat(counts).to_numpy()
                frame["doc_id"] = part["doc_id"].astype("Int64").repeat(counts).to_numpy()
                frame["text_key"] = part["text_key"].repeat(counts).to_numpy()
                yield frame.astype({"doc_id": "Int64"})

    return run


def stable_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of small whole numbers: key and place in one word, so that plain values are sorted."""
    n = len(keys)
    bits = max(n - 1, 0).bit_length()
    if n and int(keys.max()).bit_length() + bits > 64:
        return np.argsort(keys, kind="stable")
    packed = (keys.astype("uint64") << np.uint64(bits)) | np.arange(n, dtype="uint64")
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype("int64")


def ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers from 0 up, in the given order of the keys."""
    found = np.empty(len(keys), "int64")
    ordered = keys[order]
    found[order] = np.cumsum(np.concatenate([np.zeros(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]]))
    return found


def shard_order(symbols: np.ndarray, after: np.ndarray, passes: int) -> np.ndarray:
    """Suffixes of a shard sorted by their first ``2**k >= passes`` symbols, by doubling ranks."""
    jump, depth = after, 1
    order = stable_order(symbols)
    rank = ranks(symbols, order)
    while depth < passes:
        pairs = rank * len(rank) + rank[jump]
        order = stable_order(pairs)
        rank = ranks(pairs, order)
        jump, depth = jump[jump], 2 * depth
    return order


def merge_transforms(transforms: list[np.ndarray], passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes by their first ``passes`` symbols, and where runs start.

    ``transforms`` hold, in the order of a shard's suffixes, the symbol before each. A pass reads
    the merged transform in its present order and deals it stably by symbol; a run starts where
    the symbol changes or where two entries were apart already.
    """
    shard = np.repeat(np.arange(len(transforms), dtype="int32"), [len(t) for t in transforms])
    run = np.zeros(len(shard), "int64")
    merged = np.empty(len(shard), "int64")
    for _ in range(passes):
        for i, transform in enumerate(transforms):
            merged[shard == i] = transform
        order = stable_order(merged)
        shard, symbol, run = shard[order], merged[order], run[order]
        starts = np.ones(len(run), bool)
        starts[1:] = (symbol[1:] != symbol[:-1]) | (run[1:] != run[:-1])
        run = np.cumsum(starts)
    return shard, run


def symbol_chains(
    data: np.ndarray, start: np.ndarray, stop: np.ndarray, length: int, stride: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, symbol, end): chains of symbols, one after another, that can hold a repeated window.

    A window whose symbols do not all occur again is no repeat, so a chain goes on only over
    symbols that do, and is left out if it is shorter than a window. ``end`` marks the entry past
    each chain; it has a symbol of its own, so nothing matches past an end.
    """
    whole = np.flatnonzero(np.arange(len(data)) + stride < stop)
    hashes = Rolling(data).of(whole, whole + stride)
    own = ranks(hashes, np.argsort(hashes))
    again = np.zeros(len(data), bool)
    again[whole] = np.bincount(own, minlength=1)[own] > 1
    steps = range(stride, length, stride)
    first = again.copy()
    for step in steps:
        first[:-step] &= again[step:]
        first[-step:] = False
    kept = first.copy()
    for step in steps:
        kept[step:] |= first[:-step]
    past = np.zeros(len(data), bool)
    past[stride:] = kept[:-stride]
    past &= ~kept
    place = np.flatnonzero(kept | past)
    place = place[stable_order(start[place] + (place - start[place]) % stride)]
    number = np.zeros(len(data), "int64")
    number[whole] = own
    end = past[place]
    symbol = number[place]
    symbol[end] = len(data) + np.arange(int(end.sum()))
    return place, symbol, end


def repeated_starts(contexts: list[np.ndarray], length: int = LENGTH, stride: int = STRIDE, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each context a mask of its window starts: True where the window occurs elsewhere in the batch."""
    if not contexts:
        return []
    gap = np.zeros(1, "uint8")  # a place past each context, so that every chain of symbols has an end of its own
    sizes = np.array([len(c) + 1 for c in contexts])
    begins = np.cumsum(sizes) - sizes
    data = np.concatenate([part for c in contexts for part in (c, gap)])
    mask = np.zeros(len(data), bool)
    place, symbol, end = symbol_chains(data, np.repeat(begins, sizes), np.repeat(begins + sizes, sizes), length, stride)
    if len(place):
        stops = np.flatnonzero(end) + 1
        starts = np.append(0, stops[:-1])
        before = np.arange(len(place)) - 1
        before[starts] = stops - 1
        shards = np.append(stops[:-1][np.diff((stops - 1) // shard_bytes) > 0], len(place)).tolist()
        transforms, suffixes, low = [], [], 0
        for high in shards:
            back = before[low:high] - low
            after = np.empty_like(back)
            after[back] = np.arange(high - low)
            order = shard_order(symbol[low:high], after, length // stride)
            transforms.append(symbol[low:high][back[order]])
            suffixes.append(order + low)
            low = high
        shard, run = merge_transforms(transforms, length // stride)
        suffix = np.empty(len(shard), "int64")
        for i, own in enumerate(suffixes):
            suffix[shard == i] = own
        mask[place[suffix[np.bincount(run)[run] > 1]]] = True
    return [mask[b : b + max(0, s - length)] for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)]


def _contexts(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["anchor", "members", "doc_id", "text_key", "first", "alone", "data"]
        for batch in batches:
            out = []
            for doc_id, key, base, text, wanted in batch[["doc_id", "text_key", "first", "data", "wanted"]].itertuples(index=False):
                data = _bytes(text).tobytes()
                for w in wanted:
                    part = data[w["first"] - base : w["last"] - base + length]
                    out.append((w["anchor"], w["members"], doc_id, key, w["first"], w["alone"], part))
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    return run


def _merge_groups(length: int, stride: int):
    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        masks = repeated_starts([np.frombuffer(d, "uint8") for d in rows["data"]], length, stride)
        out = []
        for mask, doc_id, key, first, alone in zip(masks, rows["doc_id"], rows["text_key"], rows["first"], rows["alone"], strict=True):
            if alone and mask.any():
                edge = np.flatnonzero(np.diff(mask.astype("int8"), prepend=0, append=0))
                out += [(doc_id, key, first + s, first + e - 1) for s, e in edge.reshape(-1, 2).tolist()]
        return pd.DataFrame(out, columns=["doc_id", "text_key", "first", "last"]).astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            for at in range(0, len(batch), 500):
                held.append(batch.iloc[at : at + 500])
                size += int(held[-1]["data"].str.len().sum())
                if size < BATCH_BYTES:
                    continue
                rows = pd.concat(held)  # all but the last group, which may go on
                ids = rows["anchor"].to_numpy()
                edges = np.flatnonzero(ids[1:] != ids[:-1]) + 1
                if len(edges):
                    yield merged(rows.iloc[: edges[-1]])
                    rows = rows.iloc[edges[-1] :]
                held, size = [rows], int(rows["data"].str.len().sum())
        if held:
            yield merged(pd.concat(held))

    return run


def _with_bytes(pieces: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """(anchor, members, doc_id, text_key, first, alone, data): the members of groups, cut out of their pieces."""
    wanted = members.groupBy("doc_id", "text_key", "base").agg(
        F.collect_list(F.struct("anchor", "members", "alone", "first", "last")).alias("wanted")
    )
    wanted = wanted.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "base", "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")) & (F.col("first") == F.col("base"))
    shape = "anchor long, members long, doc_id long, text_key long, first long, alone boolean, data binary"
    rows = pieces.join(wanted, same).select("doc_id", "text_key", "first", "data", "wanted")
    return rows.mapInPandas(_contexts(length), shape)


def covered_windows(
    spark: SparkSession, texts: DataFrame, length: int = LENGTH, gram: int = GRAM, stride: int = STRIDE, cap: int = CAP
) -> DataFrame:
    """(doc_id, text_key, first, last): runs of window starts whose window also starts elsewhere."""
    schema = "anchor long, context long, first long, last long, base long, alone boolean, doc_id long, text_key long"
    member = F.struct("doc_id", "text_key", "first", "last", "base")
    pieces = texts.selectExpr("doc_id", "text_key", "0L AS first", "true AS alone", "text AS data")
    found, differing = [], []
    for size in anchor_grams(length, gram):
        anchors = saved(spark, pieces.mapInPandas(_anchor_rows(length, size), schema), "anchors")
        classes = anchors.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.max("alone").alias("alone"), F.min(member).alias("member")
        )
        again = classes.groupBy("anchor").agg(F.count("*").alias("members"), F.sum("n").alias("places")).where("places > 1")
        shared = saved(spark, classes.join(again.drop("places"), "anchor"), "shared")
        equal = anchors.join(shared.where("n > 1").select("anchor", "context"), ["anchor", "context"])
        found.append(equal.select("doc_id", "text_key", "first", "last"))
        # A member of several equal contexts has its answer; it only stands for them among the others.
        members = shared.where("members > 1").selectExpr("members", "anchor", "n = 1 AND alone AS alone", "member.*")
        contexts = saved(spark, _with_bytes(pieces, members, length), "contexts")
        pieces = contexts.where(f"members > {cap}")
        if size == length or pieces.isEmpty():
            differing.append(contexts)
            break
        differing.append(contexts.where(f"members <= {cap}"))

    contexts = reduce(DataFrame.unionByName, differing).drop("members")
    merged = contexts.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(
        _merge_groups(length, stride), "doc_id long, text_key long, first long, last long"
    )
    return reduce(DataFrame.unionByName, [*found, merged])


def _cut(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, runs in batch[["doc_id", "text", "runs"]].itertuples(index=False):
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, end, begin, spans, removed = hashlib.sha256(), 0, 0, 0, 0
                for first, last in sorted((r["first"], r["last"]) for r in runs) if runs is not None else ():
                    if first > end or not spans:
                        kept.update(data[end:first])
                        removed += end - begin
                        spans, begin, end = spans + 1, first, first
                    end = max(end, last + length)
                kept.update(data[end:])
                out.append((doc_id, len(data), removed + end - begin, spans, kept.hexdigest()))
            columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    return run


def without_repeated_bytes(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    length: int = LENGTH, gram: int = GRAM, stride: int = STRIDE, cap: int = CAP,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    if length % stride or gram > length:
        raise ValueError("the length must be a multiple of the stride and at least a gram")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    runs = covered_windows(spark, texts, length, gram, stride, cap)
    runs = runs.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    rows = texts.join(runs, same, "left").select("doc_id", "text", "runs")
    return rows.mapInPandas(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(spark, table(spark, sf_dir, "documents"))
