"""Toxicity by a bag of subwords: averaged n-gram vectors under a linear softmax.

A word is its own mark and its character n-grams, each hashed to a row of a table of vectors. A
word's vector is the mean of its rows and a document's the mean over its words; a softmax layer
reads it. Vectors and layer are trained together by gradient descent in numpy, so an unseen
misspelling gets the vectors of the n-grams that it shares with words seen.

Training takes a bounded sample of labelled rows, ``most_each`` per class at most, weighted back
to the share of the classes; scoring runs over all documents. The model is linear once trained,
so scoring keeps one number per n-gram and per word seen by a task.

Defined cases: a null or empty text scores as a document of no words; ids may be null or repeat,
every row gets its own score; null labels are left out and repeated ones averaged; without
labels of both classes every score is the share of toxic labels (0 without labels); an empty
table gives an empty result; extra columns are kept by ``clean_documents``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import in_steps, release_memory, table, tidy
from procurelens.llm.labelled import fold, smallest_hashes, texts_of, training_labels

FOLDS, HELD_OUT = 3, 1
#: Labelled rows that training reads, of each class.
MOST_EACH = 2500
#: Score from which a document counts as toxic.
THRESHOLD = 0.7
BUCKETS, DIM = 1 << 18, 4
GRAMS = (3, 4)
#: Passes over the sample; small samples get more, up to the number of steps.
EPOCHS, STEPS, BATCH, RATE = 8, 600, 64, 0.02
#: Words of no toxicity that every document counts besides its own, so that few words prove little.
PRIOR_WORDS = 20
#: Brings shares to the range where half precision is exact to a thousandth.
SHARE_SCALE = 1024.0
#: Keeps rows of small gradients, which are mostly noise, from moving as far as others.
EPSILON = 1e-5
#: Weight decay of the vectors that a batch uses.
DECAY = 0.02
#: The mean over thousands of n-grams is small; this brings it to the scale of the layer.
GAIN = 20.0
#: Bytes of the words that a task remembers, and what one takes besides its letters.
CACHE_BYTES, ENTRY_BYTES = 32 << 20, 300
_WORD = re.compile(r"[^\W_]+")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of many words at once, and the word that each row belongs to, in word order.

    A word has one row for itself and one per n-gram of its characters with marked ends.
    """
    if not words:
        return np.empty(0, "int64"), np.empty(0, "int64")
    marked = "<" + "><".join(words) + ">"
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype("uint64")
    lengths = np.fromiter(map(len, words), "int64", len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    place = (np.arange(len(codes)) - starts[word]).astype("uint64")
    rows, owners = [_mixed(np.add.reduceat(_mixed(codes + (place << np.uint64(32))), starts))], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(codes)) + n <= (starts + lengths)[word])
        gram = np.full(len(at), n, "uint64")
        for k in range(n):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + codes[at + k]
        rows.append(_mixed(gram))
        owners.append(word[at])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (rows[order] & np.uint64(BUCKETS - 1)).astype("int64"), owners[order]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class SubwordModel:
    """Trained weights folded to a score per table row, and a bias."""

    row_scores: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        rows, word = subwords(words)
        return np.bincount(word, self.row_scores[rows], len(words)) / np.maximum(np.bincount(word, minlength=len(words)), 1)

    def score(self, texts: list[str | None], known: dict[str, list[tuple[str, float]]]) -> list[float]:
        """``known`` keeps the words in a stretch between blanks and their scores."""
        bags = [Counter((t or "").lower().split()) for t in texts]
        new = list({x for bag in bags for x in bag if x not in known})
        parts = [_WORD.findall(x) for x in new]
        found = iter(self.word_scores([w for p in parts for w in p]).tolist())
        here = {x: [(w, next(found)) for w in p] for x, p in zip(new, parts, strict=True)}
        if len(known) * ENTRY_BYTES < CACHE_BYTES:
            known.update(here)
        scores = []
        for bag in bags:
            counts: dict[tuple[str, float], int] = {}
            for stretch, n in bag.items():
                for word in known[stretch] if stretch in known else here[stretch]:
                    counts[word] = counts.get(word, 0) + n
            weights = np.log1p(np.fromiter(counts.values(), "float64", len(counts)))
            values = np.fromiter((s for _, s in counts), "float64", len(counts))
            scores.append(_sigmoid(self.bias + float(weights @ values) / (float(weights.sum()) + PRIOR_WORDS)))
        return scores

    def score_batch(self, texts: list[str | None], known: dict[str, list[tuple[str, float]]], step: int = 500) -> np.ndarray:
        """Scores in small steps, so that the words of one step fit memory."""
        return np.array([x for at in range(0, len(texts), step) for x in self.score(texts[at : at + step], known)], dtype="float64")


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


#: The distinct words of a document, joined by blanks, and their counts.
Bag = tuple[str, np.ndarray]


def bag_of(text: str | None) -> Bag:
    words = Counter(_WORD.findall((text or "").lower()))
    return " ".join(words), np.fromiter(words.values(), "int32", len(words))


#: Table rows of a document with words, and the share of each in its average, times SHARE_SCALE in half precision.
Entries = tuple[np.ndarray, np.ndarray]


def entries_of(bag: Bag) -> Entries:
    rows, word = subwords(bag[0].split())
    weight = np.log1p(bag[1])
    share = weight / (weight.sum() + PRIOR_WORDS) / np.bincount(word, minlength=len(weight))
    own, back = np.unique(rows, return_inverse=True)
    return own.astype("int32"), (np.bincount(back, share[word]) * SHARE_SCALE).astype("float16")


def train(bags: list[Bag], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> SubwordModel:
    """Adam on vectors and softmax layer together; ``weights`` are per document.

    Documents without words are left out. Every table row that a document uses is trained. Between
    steps only the table rows and shares of the documents are kept; batches have fixed members
    and are put together when their turn comes, in a new order each time.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (BUCKETS, DIM)).astype("float32")
    layer, bias = rng.normal(0, 0.5, (DIM, 2)).astype("float32"), np.zeros(2, "float32")
    params = [vectors, layer, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    order = [d for d in rng.permutation(len(bags)) if len(bags[d][1])]
    entries = {d: entries_of(bags[d]) for d in order}
    batches = [order[at : at + BATCH] for at in range(0, len(order), BATCH)]
    step = 0
    for _ in range(max(epochs, -(-STEPS // max(len(batches), 1)))):
        for part in (batches[i] for i in rng.permutation(len(batches))):
            rows = np.concatenate([entries[d][0] for d in part])
            shares = np.concatenate([entries[d][1] for d in part]).astype("float32") / SHARE_SCALE
            sizes = np.array([len(entries[d][0]) for d in part])
            by_row = np.argsort(rows, kind="stable")
            row_starts = np.flatnonzero(np.diff(rows[by_row], prepend=-1))
            hidden = np.add.reduceat(vectors[rows] * shares[:, None], np.cumsum(sizes) - sizes, axis=0)
            logits = GAIN * hidden @ layer + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            slope = (chance - np.eye(2, dtype="float32")[labels[part]]) * weights[part][:, None] / len(part)
            push = shares[:, None] * np.repeat(GAIN * slope @ layer.T, sizes, axis=0)
            used, gradient = rows[by_row[row_starts]], np.add.reduceat(push[by_row], row_starts, axis=0)
            step += 1
            rate = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            everything = slice(None)
            for k, where, g in ((0, used, gradient), (1, everything, GAIN * hidden.T @ slope), (2, everything, slope.sum(axis=0))):
                mean, square = 0.9 * first[k][where] + 0.1 * g, 0.99 * second[k][where] + 0.01 * g * g
                first[k][where], second[k][where] = mean, square
                kept = 1 - rate * DECAY if k == 0 else 1
                params[k][where] = kept * params[k][where] - rate * mean / (np.sqrt(square) + EPSILON)
    across = layer[:, 1] - layer[:, 0]
    return SubwordModel(GAIN * (vectors @ across), float(bias[1] - bias[0]))


@tidy
def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words, counts = zip(*map(bag_of, batch["text"]), strict=True) if len(batch) else ((), ())
        yield pd.DataFrame({"label": batch["label"], "words": list(words), "counts": list(counts)})


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_each: int = MOST_EACH
) -> SubwordModel:
    """Train on the labels outside the held-out fold, ``2 * most_each`` rows at most."""
    known = training_labels(labels, "toxic", FOLDS, HELD_OUT)
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(share.values())
    flat = np.zeros(BUCKETS, "float32")
    if not share.get(0) or not share.get(1):
        odds = share.get(1, 0) / max(total, 1)
        return SubwordModel(flat, float(np.log(max(odds, 1e-12) / max(1 - odds, 1e-12))))
    sample = smallest_hashes(known.where("label = 0"), most_each).unionByName(smallest_hashes(known.where("label = 1"), most_each))
    got = texts_of(docs, sample, id_col, text_col).mapInPandas(_bags, "label int, words string, counts array<int>").toPandas()
    bags = list(zip(got["words"], map(np.asarray, got["counts"]), strict=True))
    y = got["label"].to_numpy()
    weights = np.ones(len(y), "float32")
    for c in (0, 1):
        weights[y == c] = share[c] / total * len(y) / max(1, (y == c).sum())
    model = train(bags, y, weights)
    del got, bags
    release_memory()
    return model


def _scores(model: SubwordModel):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list[tuple[str, float]]] = {}
        for batch in batches:
            scores = model.score_batch(batch["text"].tolist(), known)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores})

    return run


def scored(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(_scores(model), "doc_id long, score double")


def clean_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that score below the threshold, scored in one pass beside their columns."""
    model = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[str, float]]] = {}
        for batch in in_steps(batches):
            scores = model.score_batch(batch.column(at).to_pylist(), known)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(keep, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
