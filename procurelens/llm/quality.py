"""Quality by learning from positives and unlabelled text (non-negative risk).

A trusted positive is a labelled good document. Nothing is known of the unlabelled web text but
the class prior, the share of good documents in it, which is estimated from the labels of the
training folds. With loss l, score g, prior p, positives P and unlabelled U, training minimises

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])

whose second part is the risk on the hidden negatives; when a batch drives it below zero, the
step goes the other way, as in non-negative PU learning. The scorer is linear over the square
roots of the frequencies of character-class pairs (lower and upper case, digit, blank, line end,
each ASCII punctuation mark) and a few measures of repetition and length.

Training reads bounded samples (``most_positive``, ``most_unlabelled`` rows) and brings them to the mean
and spread that the features have over all documents; scoring runs over all documents. Defined cases: a null or empty text has all-zero features and gets a score like
any other; ids may be null or repeat, every row gets its own score; null labels are left out and
repeated ones averaged; without a positive label every score is 0, without unlabelled texts 1;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import release_memory, table, tidy
from procurelens.llm.labelled import fold, smallest_hashes, texts_of, training_labels

FOLDS, HELD_OUT = 5, 0
#: Rows that training reads.
MOST_POSITIVE, MOST_UNLABELLED = 3000, 6000
#: Score from which a document counts as good.
THRESHOLD = 0.3
STEPS, BATCH, RATE, DECAY = 3000, 256, 0.05, 1e-5
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    """Class of each byte: 0 lower case and other letters, 1 upper case, 2 digit, 3 line end, 4 blank, then marks."""
    known = np.zeros(256, "int64")
    known[ord("A") : ord("Z") + 1] = 1
    known[ord("0") : ord("9") + 1] = 2
    known[[10, 13]] = 3
    known[[9, 11, 12, 32]] = 4
    for i, mark in enumerate(_MARKS):
        known[ord(mark)] = 5 + i
    return known


_CLASS = _classes()
_KINDS = 5 + len(_MARKS)
_MEASURES = 6
WIDTH = _KINDS * _KINDS + _MEASURES


def features(text: str | None) -> np.ndarray:
    out = np.zeros(WIDTH, "float32")
    if not text:
        return out
    kinds = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), "uint8")]
    pairs = kinds[:-1] * _KINDS + kinds[1:]
    out[: _KINDS * _KINDS] = np.sqrt(np.bincount(pairs, minlength=_KINDS * _KINDS) / max(len(pairs), 1))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, text))
    count = Counter(words)
    out[-_MEASURES:] = (
        np.log1p(len(text)) / 10,
        len(count) / max(len(words), 1),
        len(set(lines)) / max(len(lines), 1),
        letters / len(text),
        sum(map(len, words)) / max(len(words), 1) / 20,
        sum(map(eq, words, words[1:])) / max(len(words), 1),
    )
    return out


@dataclass
class LinearScorer:
    weights: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -60, 60)))


def train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, scale: tuple[np.ndarray, np.ndarray] | None = None,
    steps: int = STEPS, seed: int = 11,
) -> LinearScorer:
    """Stochastic minimisation of the non-negative risk with the logistic loss.

    ``scale`` holds the mean and standard deviation of the features, by default those of ``unlabelled``.
    """
    rng = np.random.default_rng(seed)
    width = positive.shape[1]
    weights, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    mean, spread = scale or (unlabelled.mean(axis=0), unlabelled.std(axis=0))
    mean, spread = mean.astype("float32"), spread.astype("float32") + np.float32(0.01)

    def ready(rows: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((rows - mean) / spread, -5, 5), np.ones((len(rows), 1), "float32")])

    positive, unlabelled = ready(positive), ready(unlabelled)

    def chance(rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ weights, -60, 60)))

    for step in range(1, steps + 1):
        p = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        cp, cu = chance(p), chance(u)
        hidden = -np.log1p(-np.minimum(cu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(cp, 1 - 1e-12)).mean()
        to_hidden = (u.T @ cu - prior * (p.T @ cp)) / BATCH
        slope = -to_hidden if hidden < 0 else to_hidden - prior * (p.T @ (1 - cp)) / BATCH
        slope[:-1] += DECAY * weights[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * first / (np.sqrt(second) + 1e-8)
    flat = weights[:-1] / spread
    return LinearScorer(flat.astype("float32"), float(weights[-1] - mean @ flat))


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [features(t).astype("float16").tobytes() for t in batch["text"]]
        yield pd.DataFrame({"positive": batch["positive"], "features": rows})


@tidy
def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, total, square = 0, np.zeros(WIDTH), np.zeros(WIDTH)
    for batch in batches:
        for text in batch["text"]:
            row = features(text).astype("float64")
            n, total, square = n + 1, total + row, square + row * row
    if n:
        yield pd.DataFrame({"n": [n], "sums": [total], "squares": [square]})


def scale_of(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and standard deviation of every feature over all documents; None without documents.

    A task gives one row of sums, and those are added feature by feature in Spark.
    """
    parts = docs.select(F.col(text_col).alias("text")).mapInPandas(_moments, "n long, sums array<double>, squares array<double>")
    each = parts.select("n", F.posexplode(F.arrays_zip("sums", "squares")).alias("k", "both"))
    rows = each.groupBy("k").agg(F.sum("n").alias("n"), F.sum("both.sums").alias("x"), F.sum("both.squares").alias("xx")).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values("k")
    mean = (rows["x"] / rows["n"]).to_numpy()
    return mean, np.sqrt(np.maximum((rows["xx"] / rows["n"]).to_numpy() - mean**2, 0))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED,
) -> LinearScorer:
    """Train on trusted positives and unlabelled text, both bounded samples."""
    known = training_labels(labels, "quality", FOLDS, HELD_OUT)
    good, total = known.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    positives = smallest_hashes(known.where("label = 1").select("doc_id"), most_positive).select("doc_id", F.lit(True).alias("positive"))
    # The other half of the hash order, so that the two samples meet as little as possible.
    unlabelled = ids.orderBy(F.xxhash64("doc_id").desc(), "doc_id").limit(most_unlabelled).distinct()
    sample = positives.unionByName(unlabelled.select("doc_id", F.lit(False).alias("positive")))
    got = texts_of(docs, sample, id_col, text_col).mapInPandas(_feature_rows, "positive boolean, features binary").toPandas()
    rows = np.frombuffer(b"".join(got["features"]), "float16").reshape(-1, WIDTH).astype("float32")
    positive = got["positive"].to_numpy(dtype=bool)
    if not positive.any() or positive.all():
        return LinearScorer(np.zeros(WIDTH, "float32"), 60.0 if positive.any() else -60.0)
    model = train(rows[positive], rows[~positive], good / total, scale_of(docs, text_col))
    del got, rows
    release_memory()
    return model


def _scores(model: LinearScorer):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [float(model.score(features(t))) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": np.array(scores, dtype="float64")})

    return run


def scored(docs: DataFrame, model: LinearScorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(_scores(model), "doc_id long, score double")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
