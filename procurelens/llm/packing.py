"""Packing token ids into sequences of fixed length: best-fit decreasing over a segment tree.

A task turns texts into ids. Texts of Latin letters and common punctuation go word by word: the
tokenizer's pattern never crosses white space, so the ids of a text are those of its words, and
the ids of the words that a task met first are remembered up to a bound. All other texts go
through the tokenizer whole, and so do all texts if the tokenizer's file states other steps than
those that the words rely on. Documents longer than a sequence are first cut into full windows, which
need no packing; what is left of them, and all shorter documents, are packed by decreasing
length, each into the open sequence with the least room that still suffices. A segment tree
over the remaining room (0 to the length of a sequence) finds it in a few steps.

Packing runs in shards of about ``shard_rows`` pieces, dealt by a hash, so no task grows with
the input and a sequence never needs two tasks. Only lengths and checksums are shuffled.

Defined cases: a null or empty text is the one end id; rows that repeat are packed each on
their own; ids may be null; an empty table gives an empty result; extra columns are ignored.
A sequence whose fill is a power of two is not padded (``padding`` is 0 there).
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import saved, table, tidy

SEQUENCE = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
SHARD_ROWS = 20_000
#: Bytes of the words between white space whose ids a task remembers, and of the words of the tokenizer's
#: pattern whose ids a worker does; what one takes besides its letters and ids.
WORD_BYTES, UNIT_BYTES, ENTRY_BYTES = 24 << 20, 24 << 20, 220
#: Characters that lower-case and normalise alike in every Unicode version, without \x1c to \x1f.
_PLAIN = re.compile("[\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_UNITS = regex.compile(_PATTERN)
#: The steps before the model for which a text's ids are those of its words.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_PIECES = "doc_id long, nth long, start long, length long, ids_crc32 long, doc_tokens long"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level BPE writes for bytes: printable ones themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def goes_by_words(tokenizer) -> bool:
    """Whether the tokenizer has the steps that encoding word by word restates, and added tokens that ``<|`` betrays."""
    steps = [json.loads(step.__getstate__()) if step else None for step in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
    added = tokenizer.get_added_tokens_decoder().values()
    return steps == [_NORMALIZER, _PRE_TOKENIZER] and all("<|" in token.content for token in added)


class WordEncoder:
    """Ids of texts as unsigned little-endian 32-bit integers, remembering the ids of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A file may ask for a length; every id of a text is wanted here.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = goes_by_words(self.tokenizer)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop the words of a task; the fewer units of words stay, within their bound."""
        self.words = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def unit(self, unit: str) -> bytes:
        found = self.units.get(unit)
        if found is None:
            tokens = self.model.tokenize(unit.encode().decode("latin-1").translate(self.letters))
            found = array("I", [t.id for t in tokens]).tobytes()
            if len(self.units) * ENTRY_BYTES < UNIT_BYTES:
                self.units[unit] = found
        return found

    def word(self, word: str) -> bytes:
        found = b"".join(map(self.unit, _UNITS.findall(word)))
        if len(self.words) * ENTRY_BYTES < WORD_BYTES:
            self.words[word] = found
        return found

    def ids(self, text: str) -> bytes:
        if not self.by_words or "<|" in text or not _PLAIN.fullmatch(text):
            return self.whole(text)
        known = self.words.get
        return b"".join([known(w) or self.word(w) for w in text.lower().split()])


#: The tokenizer of a worker process, which Spark uses again for its next tasks; words are forgotten with the task.
_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _token_pieces(tokenizer: str, sequence: int, end_id: int):
    @tidy
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        encoder = _encoder(public_tokenizers.path(tokenizer))
        end, nth = np.array([end_id], dtype="<u4").tobytes(), 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.ids(text or "") + end
                tokens = len(ids) // 4
                for start in range(0, tokens, sequence):
                    piece = ids[4 * start : 4 * (start + sequence)]
                    out.append((doc_id, nth, start, len(piece) // 4, zlib.crc32(piece), tokens))
                    nth += 1
            frame = pd.DataFrame(out, columns=["doc_id", "nth", "start", "length", "ids_crc32", "doc_tokens"])
            yield frame.astype({"doc_id": "Int64"})
        encoder.forget()

    return cut


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = TOKENIZER, sequence: int = SEQUENCE, end_id: int = END_ID,
) -> DataFrame:
    """Documents as ids, cut into full windows and a rest; one row per piece."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(_token_pieces(tokenizer, sequence, end_id), _PIECES)


class RoomTree:
    """A segment tree over remaining room: how many open sequences have it, and which."""

    def __init__(self, sequence: int):
        self.leaves = 1 << sequence.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(sequence + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence_id: int) -> None:
        self.open[room].append(sequence_id)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The open sequence with the least room of at least ``need``, or None."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1  # climb until a right neighbour has something
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; lengths fall."""
    tree, opened = RoomTree(sequence), 0
    at, offset = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length)
        if found is None:
            found, opened = (opened, sequence), opened + 1
        at[i], offset[i] = found[0], sequence - found[1]
        if found[1] > length:
            tree.put(found[1] - length, found[0])
    return at, offset


def _pack_shard(sequence: int):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32", "nth"], ascending=[False] + 4 * [True])
        at, offset = best_fit(rows["length"].to_numpy(), sequence)
        fill = np.bincount(at, weights=rows["length"].to_numpy())[at].astype("int64")
        whole = (fill & (fill - 1)) == 0
        return rows.assign(
            sequence_id=at + (int(key[0]) << 32), offset=offset, padding=np.where(whole, 0, sequence - fill)
        )[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding"]]

    return pack


def pack(pieces: DataFrame, sequence: int = SEQUENCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Place written pieces into sequences."""
    shards = max(1, -(-pieces.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "nth"), F.lit(shards)))
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long, padding long"
    )
    return dealt.groupBy("shard").applyInPandas(_pack_shard(sequence), schema)


def pack_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(saved(spark, token_pieces(docs, id_col, text_col), "pieces"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))
