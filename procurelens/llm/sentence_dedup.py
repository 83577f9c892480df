"""Substring dedup by sliding sentence spans.

A text is cut into sentences, at every sentence the run of ``SPAN`` consecutive sentences is
hashed, and hashes meet globally. The first span of a hash, by document id and place, stays; the
sentences that any other span of the hash covers are removed.

A sentence ends after a word that ends in a mark (``MARKS``) or at a line end. Longer stretches
are also cut at places that their words alone decide: after a word whose hash, taken with the word
before it, is the smallest within ``REACH`` words on both sides, where a mark, a line end and the
start of the text count as smallest of all. So a passage is cut alike wherever it stands. Where
no place is smallest for more than ``MAX_SENTENCE_WORDS``, which takes a word or two or three words
that repeat, cuts follow every ``REPEAT_WORDS``, so that runs start at each word of the repeat. In
scripts without blanks every character is a word.

A run of fewer than ``MIN_WORDS`` words, which would repeat by chance, takes as many more sentences
as reach that count; only where the text ends before it there is no span, and an earlier run then
covers those sentences. A text in which no run fits is one run as a whole.

Runs of 128 bits meet in three passes over the texts. The first counts the first half of every hash, a
number per run and no text. From those seen more than once comes a filter of bits, if it is small
enough to send (``FILTER_BYTES``); the second pass writes only the runs that it lets through, with
their places, and the exact join on both halves decides. First places are combined on the map side, and
runs meet them in a join that adaptive execution can split, so a passage in a third of all documents
is no single task. The third pass takes the sentences out.

Defined cases: a null or empty text has no sentences and an empty kept text; null ids come
first; rows that repeat id and text are one document and share its answer; ties cannot be, since
a place is one span; white space before a removed sentence goes with it, white space at the end
of a text is dropped; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import in_steps, saved, table, tidy

SPAN = 2
MIN_WORDS = 10
MAX_SENTENCE_WORDS = 20
#: Words on both sides among which the hash at a cut is the smallest.
REACH = 3
#: Words between cuts where up to ``REACH`` words repeat; shares no factor with 2 or 3.
REPEAT_WORDS = 7
#: Marks that end a sentence, with the full-width, Arabic and Indic ones.
MARKS = ".!?。！？｡．؟۔।"
#: First and last code points of scripts without blanks: Thai and Lao, Burmese, Khmer, kana, Han.
UNSPACED = ((0xE01, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3041, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Rows that are cut at a time.
STEP = 200
#: Most bytes of the filter, and bits that it has for each hash.
FILTER_BYTES, FILTER_BITS = 32 << 20, 16
#: Odd factors of the two hashes of a run, and their inverses modulo 2**64.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], "uint64")
_INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in _FACTORS], "uint64")
#: Powers of the factors and of their inverses, lengthened as texts need it.
_POWERS = [np.ones((1, 2), "uint64"), np.ones((1, 2), "uint64")]
#: Whether a code point below 2**16 is a mark.
_IS_MARK = np.zeros(1 << 16, bool)
_IS_MARK[[ord(c) for c in MARKS]] = True
_BLANKS = "\t\n\x0b\x0c\r "


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sentence_ends(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each sentence ends in the text, and how many words end up to there."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    line = (codes >= 10) & (codes <= 13)
    blank = line | (codes == 9) | (codes == 32)
    alone = np.zeros(len(codes), bool)
    if len(codes) and codes.max() >= UNSPACED[0][0]:
        for low, high in UNSPACED:
            alone |= (codes >= low) & (codes <= high)
    edge = np.ones(len(codes) + 1, bool)
    edge[1:-1] = (blank[1:] != blank[:-1]) | alone[1:] | alone[:-1]
    at = np.flatnonzero(edge)
    word = np.flatnonzero(~blank[at[:-1]])
    starts, stops = at[word], at[word + 1]
    n = len(starts)
    if not n:
        return np.empty(0, "int64"), np.empty(0, "int64")
    place = np.arange(len(codes)) - np.repeat(at[:-1], np.diff(at))
    own = np.add.reduceat(_mixed(codes + (place.astype("uint64") << np.uint64(32))), at[:-1])[word]
    value = _mixed(own * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([[np.uint64(0)], own[:-1]])) | np.uint64(1)
    lines = np.concatenate([[0], np.cumsum(line)])
    ends = _IS_MARK[np.minimum(codes[stops - 1], len(_IS_MARK) - 1)] | np.append(lines[starts[1:]] > lines[stops[:-1]], True)
    value[ends] = 0
    wide = np.concatenate([np.full(REACH - 1, ~np.uint64(0)), [np.uint64(0)], value, np.full(REACH, ~np.uint64(0))])
    least = value > 0
    for k in range(1, REACH + 1):
        least &= (value < wide[REACH - k : REACH - k + n]) & (value <= wide[REACH + k : REACH + k + n])
    cuts = np.flatnonzero(ends | least) + 1
    gaps = np.diff(cuts, prepend=0)
    more = np.where(gaps > MAX_SENTENCE_WORDS, (gaps - 1) // REPEAT_WORDS, 0)
    if more.any():
        first = np.repeat(np.cumsum(more) - more, more)
        late = np.repeat(cuts - gaps, more) + (np.arange(more.sum()) - first + 1) * REPEAT_WORDS
        cuts = np.sort(np.concatenate([cuts, late]))
    return stops[cuts - 1], cuts


def run_ends(words: np.ndarray, span: int, min_words: int) -> np.ndarray:
    """The sentence after the run that starts at each; 0 where the text ends too early. ``words`` are running counts."""
    n = len(words)
    before = np.concatenate([[0], words[:-1]])
    stops = np.maximum(np.searchsorted(words, before + min_words) + 1, np.arange(n) + span)
    stops = np.where(stops <= n, stops, 0)
    if n and not stops.any():
        stops[0] = n
    return stops


def sentences(text: str) -> tuple[list[str], np.ndarray]:
    """The sentences of a text with the white space before them, and the running count of words."""
    ends, words = sentence_ends(text)
    places = [0, *ends.tolist()]
    return [text[a:b] for a, b in zip(places, places[1:], strict=False)], words


def run_hashes(pieces: list[str], stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs begin, and the two hashes of each; white space before a sentence does not count.

    A run's hash is a polynomial in those of its sentences, from running sums over the text.
    """
    at = np.flatnonzero(stops)
    digests = b"".join(map(xxhash.xxh3_128_digest, [p.lstrip(_BLANKS) for p in pieces]))
    own = np.frombuffer(digests, "<u8").reshape(-1, 2)
    powers, back = _powers(len(pieces))
    sums = np.zeros((len(pieces) + 1, 2), "uint64")
    np.cumsum(own * powers[: len(pieces)], axis=0, out=sums[1:])
    return at, _mixed((sums[stops[at]] - sums[at]) * back[at]).view("int64")


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) <= n:
        for i, factors in enumerate((_FACTORS, _INVERSES)):
            rows = np.tile(factors, (2 * n, 1))
            _POWERS[i] = np.cumprod(np.vstack([np.ones((1, 2), "uint64"), rows]), axis=0)
    return _POWERS


def _runs_of(text: str, span: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hashes of every run of a text."""
    pieces, words = sentences(text)
    stops = run_ends(words, span, min_words) if len(words) else words
    at, hashes = run_hashes(pieces, stops)
    return at, stops[at], hashes


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _counts(span: int, min_words: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_steps(batches, STEP):
            found = [_runs_of(t, span, min_words)[2][:, 0] for t in batch.column(0).to_pylist()]
            hashes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["h1", "n"])

    return run


def repeated_hashes(spark: SparkSession, texts: DataFrame, span: int, min_words: int) -> DataFrame:
    """(h1): the first halves of hashes that more than one run has; some may differ in the second half."""
    counts = texts.select("text").mapInArrow(_counts(span, min_words), "h1 long, n long")
    return saved(spark, counts.groupBy("h1").agg(F.sum("n").alias("n")).where("n > 1").select("h1"), "repeated")


def bit_filter(repeated: DataFrame, most_bytes: int = FILTER_BYTES) -> np.ndarray | None:
    """Words of bits that have two bits set for each hash; None if it would be larger than ``most_bytes``.

    The upper half of a hash chooses the word, the lower twelve bits the bits in it.
    """
    size = 1 << max(0, (max(1, repeated.count()) * FILTER_BITS // 64 - 1).bit_length())
    if size * 8 > most_bytes:
        return None
    word = F.pmod(F.shiftright("h1", 32), F.lit(size))
    bits = F.expr("shiftleft(1L, cast(h1 & 63 as int)) | shiftleft(1L, cast(shiftright(h1, 6) & 63 as int))")
    # One row per word of the filter, which is at most ``most_bytes``.
    rows = repeated.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size, "int64")
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return words


def let_through(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = (np.int64(1) << (hashes & 63)) | (np.int64(1) << ((hashes >> 6) & 63))
    return (words[(hashes >> 32) & (len(words) - 1)] & bits) == bits


def _places(span: int, min_words: int, words: np.ndarray | None):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_steps(batches, STEP):
            rows, parts = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                at, stop, hashes = _runs_of(text, span, min_words)
                good = slice(None) if words is None else let_through(words, hashes[:, 0])
                parts.append((hashes[good], at[good], stop[good]))
                rows.append(len(parts[-1][1]))
            hashes, at, stop = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = pa.array(np.repeat(np.arange(len(rows)), rows))
            columns = [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column(0).take(row), batch.column(1).take(row)]
            columns += [pa.array(at.astype("int32")), pa.array(stop.astype("int32"))]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "text_key", "at", "stop"])

    return run


def repeated_spans(spark: SparkSession, texts: DataFrame, span: int, min_words: int, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, text_key, spans): the runs (at, stop) that another document or an earlier place has first."""
    words = bit_filter(repeated_hashes(spark, texts, span, min_words), most_bytes)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"h1 long, h2 long, doc_id {kind}, text_key long, at int, stop int"
    places = saved(spark, texts.mapInArrow(_places(span, min_words, words), schema), "spans")
    place = F.struct("doc_id", "text_key", "at")
    first = places.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = places.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "stop")).alias("spans"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_steps(batches, STEP):
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not spans:
                ends, _ = sentence_ends(text)
                out.append((len(ends), 0, 0, text[: ends[-1]] if len(ends) else ""))
                continue
            pieces, _ = sentences(text)
            gone = np.zeros(len(pieces) + 1, "int64")
            for s in spans:
                gone[s["at"]] += 1
                gone[s["stop"]] -= 1
            covered = np.cumsum(gone)[:-1] > 0
            kept = "".join(p for p, c in zip(pieces, covered.tolist(), strict=True) if not c)
            out.append((len(pieces), int(covered.sum()), len(spans), kept))
        columns = [batch.column(0), *(pa.array(c) for c in zip(*out, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_sentences", "n_removed", "n_spans", "kept_text"])


def without_repeats(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
    min_words: int = MIN_WORDS, most_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(doc_id, n_sentences, n_removed, n_spans, kept_text) of every row."""
    texts = _texts(docs, id_col, text_col)
    found = repeated_spans(spark, texts, span, min_words, most_bytes)
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    rows = texts.join(found, same, "left").select("doc_id", "text", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_kept), f"doc_id {kind}, n_sentences long, n_removed long, n_spans long, kept_text string")


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark, table(spark, sf_dir, "documents"))
