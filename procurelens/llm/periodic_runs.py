"""Runs of repeated words, exact, by recompression of the word sequence.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST, 2 * q)``
words that no neighbouring word extends. Each task works on its documents in batches:

1. The words of a batch become numbers, documents end in numbers of their own, and recompression
   turns the sequence into a run-length grammar. Levels alternate: blocks of one symbol become a
   symbol, then pairs whose first symbol is of the left half of the alphabet and whose second is of
   the right one. What a level does at a place depends on the symbols there alone, so equal stretches
   are parsed alike but for one symbol at their edges.
2. A run of period q holds a place k * q and the place one period on. Those harmonic grid places are
   the candidates; those with different words there are none.
3. The words that agree after two places are counted on the grammar (``Grammar.common``): both places
   climb while they start symbols, step over one symbol or block where they do not, and come down
   again from the first difference, one comparison a level. A grammar of the reversed sequence counts
   backwards. All queries move level by level in numpy. No suffix array and no hash is involved.
4. A run is what the two counts give; of one stretch found for several periods the smallest counts.

Documents are independent, so nothing is shuffled; memory follows the batch, which is ``BATCH_WORDS``
words or one document, if it is longer, and ``CHUNK`` candidates at a time.

Defined cases: a null or empty text has no words, no runs and an empty kept text; null ids and
repeated rows are rows like any other, each with its own answer; ties for the greatest run go to the
smallest start, then period; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import table

#: Fewest words of a run.
LEAST = 12
#: Words of the documents that share a grammar, and candidates that are looked at together.
BATCH_WORDS = 150_000
CHUNK = 400_000


def _named(keys: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """New symbols from ``first`` for keys, equal ones for equal keys, and the symbol after the last."""
    distinct, names = np.unique(keys, return_inverse=True)
    return (names + first).astype("int32"), first + len(distinct)


def _blocks(symbols: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts of the blocks of one symbol, the block symbols, and the next free symbol."""
    starts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    sizes = np.diff(np.append(starts, len(symbols)))
    above = symbols[starts]
    long = sizes > 1
    if long.any():
        above = above.copy()
        above[long], free = _named(above[long].astype("int64") * (int(sizes.max()) + 1) + sizes[long], free)
    return starts, above, free


def _pairs(symbols: np.ndarray, free: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts of the pairs and single symbols, their symbols, and the next free symbol."""
    left = rng.integers(0, 2, free).astype(bool)[symbols]
    first, second = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
    if np.count_nonzero(second) > np.count_nonzero(first):
        first = second  # the halves change places
    at = np.flatnonzero(first)
    starts = np.delete(np.arange(len(symbols)), at + 1)
    above = symbols[starts].copy()
    if len(at):
        names, free = _named(symbols[at].astype("int64") * free + symbols[at + 1], free)
        above[np.searchsorted(starts, at)] = names
    return starts, above, free


@dataclass
class Level:
    """Symbols of a level; ``up`` and ``head``: the symbol above each, and whether it is its first child;
    ``starts``: the first child of each symbol above, and the end."""

    symbols: np.ndarray
    up: np.ndarray
    head: np.ndarray
    starts: np.ndarray
    blocks: bool

    def left_in_block(self, at: np.ndarray) -> np.ndarray:
        return self.starts[self.up[at] + 1] - at


class Grammar:
    """The levels of a sequence, from words to one symbol."""

    def __init__(self, symbols: np.ndarray, seed: int = 5):
        rng, free = np.random.default_rng(seed), int(symbols.max(initial=0)) + 1
        self.levels: list[Level] = []
        symbols = symbols.astype("int32")
        blocks = True
        while len(symbols) > 1:
            starts, above, free = _blocks(symbols, free) if blocks else _pairs(symbols, free, rng)
            head = np.zeros(len(symbols), bool)
            head[starts] = True
            up = (np.cumsum(head) - 1).astype("int32")
            self.levels.append(Level(symbols, up, head, np.append(starts, len(symbols)).astype("int32"), blocks))
            symbols, blocks = above, not blocks

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols agree from places ``a`` and ``b`` on, for places of the sequence that differ."""
        x, y = a.astype("int64"), b.astype("int64")
        differ = np.full(len(x), -1, "int16")  # the level of the first difference
        active = np.arange(len(x))
        for number, level in enumerate(self.levels):
            if not len(active):
                break
            p, q = x[active], y[active]
            inside = ~(level.head[p] & level.head[q])
            p, q, who = p[inside], q[inside], active[inside]
            same = level.symbols[p] == level.symbols[q]
            differ[who[~same]] = number
            p, q, who = p[same], q[same], who[same]
            if level.blocks:
                room, other = level.left_in_block(p), level.left_in_block(q)
                step = np.minimum(room, other)
                # The longer block goes on where the shorter one has ended: a difference on this level.
                differ[who[room != other]] = number
            else:
                step = 1
            x[who], y[who] = p + step, q + step
            if not level.blocks:
                odd = ~(level.head[x[who]] & level.head[y[who]])
                differ[who[odd]] = number
            active = active[differ[active] < 0]
            x[active], y[active] = level.up[x[active]], level.up[y[active]]
        differ[active] = len(self.levels)
        order = np.argsort(-differ, kind="stable")
        falling = -differ[order]
        for number in range(int(differ.max(initial=0)) - 1, -1, -1):
            level = self.levels[number]
            who = order[: np.searchsorted(falling, -number, side="left")]  # those that differ above this level
            p, q = level.starts[x[who]].astype("int64"), level.starts[y[who]].astype("int64")
            same = level.symbols[p] == level.symbols[q]
            if level.blocks:
                step = np.where(same, np.minimum(level.left_in_block(p), level.left_in_block(q)), 0)
            else:
                step = same
            x[who], y[who] = p + step, q + step
        return x - a


def _grid(lengths: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place, period) of the harmonic grid, chunk by chunk."""
    periods = lengths // 2
    periods[lengths < least] = 0
    ends = np.cumsum(periods)
    total = int(ends[-1]) if len(ends) else 0
    at = 0
    while at < total:
        # Period rows (document, q), then their places; a chunk ends after a whole period row.
        rows = np.arange(at, min(at + CHUNK, total))
        doc = np.searchsorted(ends, rows, side="right")
        q = rows - (ends[doc] - periods[doc]) + 1
        places = (lengths[doc] - 1) // q
        upto = np.cumsum(places)
        take = max(1, int(np.searchsorted(upto, CHUNK, side="right")))
        doc, q, places = doc[:take], q[:take], places[:take]
        at += take
        size = int(places.sum())
        nth = np.arange(size) - np.repeat(np.cumsum(places) - places, places)
        yield np.repeat(doc, places), nth * np.repeat(q, places), np.repeat(q, places)


def _smallest(doc: np.ndarray, start: np.ndarray, length: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each stretch once, with its smallest period."""
    order = np.lexsort((q, length, start, doc))
    doc, start, length, q = doc[order], start[order], length[order], q[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return doc[new], start[new], length[new], q[new]


def batch_runs(sequences: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs of many sequences of symbols, by document, start and period."""
    lengths = np.array([len(s) for s in sequences], "int64")
    free = max((int(s.max(initial=0)) for s in sequences), default=0) + 1
    whole = np.concatenate([x for i, s in enumerate(sequences) for x in (s, [free + i])]) if sequences else np.empty(0, "int64")
    bases = np.cumsum(lengths + 1) - lengths - 1
    forward = mirror = None
    found = [(np.empty(0, "int64"),) * 4]
    for doc, place, q in _grid(lengths, least):
        at = bases[doc] + place
        near = whole[at] == whole[at + q]
        doc, at, q = doc[near], at[near], q[near]
        if not len(at):
            continue
        if forward is None:
            # The text before the first document needs an end of its own, too.
            forward, mirror = Grammar(whole), Grammar(np.append(whole[::-1], free + len(sequences)))
        last = len(whole) - 1
        before = mirror.common(last - at + 1, last - at - q + 1)
        length = forward.common(at, at + q) + before + q
        good = length >= np.maximum(least, 2 * q)
        found.append(_smallest(doc[good], (at - before - bases[doc])[good], length[good], q[good]))
    doc, start, length, q = _smallest(*map(np.concatenate, zip(*found, strict=True)))
    order = np.lexsort((q, start, doc))
    return doc[order], start[order], length[order], q[order]


#: Words of a text and its id -> the words whose runs are looked for.
Edit = Callable[[list[bytes], "int | None"], list[bytes]]


def _answers(ids: list, words: list[list[bytes]], least: int) -> dict[str, list]:
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    sequences = [np.fromiter(map(known.__getitem__, ws), "int64", len(ws)) for ws in words]
    doc, start, length, period = batch_runs(sequences, least)
    first, last = np.searchsorted(doc, np.arange(len(words))), np.searchsorted(doc, np.arange(len(words)), side="right")
    out: dict[str, list] = {name: [] for name in _SCHEMA.names}
    for i, ws in enumerate(words):
        own = slice(first[i], last[i])
        s, n, q = start[own], length[own], period[own]
        best = int(np.lexsort((q, s, -n))[0]) if len(s) else None
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist(), strict=True))
        kept = ws
        if len(s):
            cover = np.zeros(len(ws) + 1, "int32")
            np.add.at(cover, s + q, 1)
            np.add.at(cover, s + n, -1)
            kept = [w for w, c in zip(ws, np.cumsum(cover)[:-1].tolist(), strict=True) if not c]
        out["doc_id"].append(ids[i])
        out["n_words"].append(len(ws))
        out["n_runs"].append(len(s))
        for name, values in (("start", s), ("length", n), ("period", q)):
            out[name].append(None if best is None else int(values[best]))
        out["exponent_milli"].append(None if best is None else 1000 * int(n[best]) // int(q[best]))
        out["runs"].append(lines)
        out["collapsed"].append(b" ".join(kept).decode())
    return out


_SCHEMA = pa.schema(
    [pa.field("doc_id", pa.int64()), pa.field("n_words", pa.int64()), pa.field("n_runs", pa.int64())]
    + [pa.field(name, pa.int64()) for name in ("start", "length", "period", "exponent_milli")]
    + [pa.field("runs", pa.string()), pa.field("collapsed", pa.string())]
)
_DDL = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs string, collapsed string"


def _find(least: int, edit: Edit | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(_answers(ids, words, least), _SCHEMA)

        for batch in batches:
            column = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = column[i].as_py() or b""
                ws = text.split()  # splits at the six white-space characters
                ws = edit(ws, doc_id) if edit else ws
                if ids and size + len(ws) > BATCH_WORDS:
                    yield flush()
                    ids, words, size = [], [], 0
                ids.append(doc_id)
                words.append(ws)
                size += len(ws) + 1
        if ids:
            yield flush()

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, edit: Edit | None = None
) -> DataFrame:
    """Per document: n_words, n_runs, the greatest run, all runs as lines ``start,length,period`` and the collapsed text.

    The collapsed text is the words that no run covers after its first period, joined by one space.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_find(least, edit), _DDL)


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The edit of the query: of one document in ten the words from some place on repeat the first of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
