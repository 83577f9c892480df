"""Ranked lexical search: accumulator-limited term-at-a-time over shards of the documents.

Queries come in blocks of ``BLOCK_USES`` terms at most, counted once per query, so what the tasks
get is bounded whatever the number of queries. For each block:

1. One pass over the documents cuts every whole text into terms and writes, per document, its number
   of terms and how often each term of the block occurs. Corpus counts (documents, terms, documents
   of a term) are sums over that table.
2. Each task reads its part of the table in shards of ``SHARD_DOCS`` documents. A query's terms are
   taken rarest first; each adds its parts of the score to the accumulators of its documents. Once
   the terms left cannot bring a document without an accumulator to the k-th partial score, no more
   are made; terms then only update the ones there, so the scores of the best are exact. The bound of
   a term is its weight times its greatest factor in the shard; the k-th score of the task's earlier
   shards counts as well. No posting is shuffled.
3. The best k per query and task meet in two windows, over buckets of documents and over the query.

All numbers are whole but for the logarithm, so results do not depend on the order of additions.

Defined cases: null and empty texts have no terms, count as no document and are never found; queries
without terms have no rows; each row of either table is a document or query of its own, also when ids
repeat; ties go by ascending document id, null ids last; empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procurelens.llm.common import fresh, saved, table

TOP = 50
BLOCK_USES = 200_000
SHARD_DOCS = 8192
#: Buckets of documents in which the best of the tasks meet first.
BUCKETS = 64
#: Bytes of UTF-8 that belong to terms map to themselves, A to Z to small letters, others to a blank (fixed rule).
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of digits, letters and characters beyond ASCII, A to Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass
class Block:
    """Queries and their terms: ``queries[i]`` has the term numbers of query ``numbers[i]``."""

    numbers: list[int] = field(default_factory=list)
    queries: list[list[int]] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)

    def add(self, number: int, terms: list[bytes]) -> None:
        self.numbers.append(number)
        self.queries.append([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms])


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(2)]
        columns = [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["number", "item_id", "terms"])


def _index(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids, sizes, terms, counts = [], [], [], []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = terms_of(text.as_py())
                    if words:
                        found = {vocabulary[t]: n for t, n in Counter(words).items() if t in vocabulary}
                        ids.append(doc_id)
                        sizes.append(len(words))
                        terms.append(list(found))
                        counts.append(list(found.values()))
                lists = pa.list_(pa.int32())
                columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, lists), pa.array(counts, lists)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


class Best:
    """The best documents of one query so far, best first."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.empty(0, "int64")
        self.missing = np.empty(0, bool)

    @property
    def threshold(self) -> int:
        """A score that a document must reach to count, 1 while there are fewer than k."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def merge(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        missing = np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


class Shard:
    """Postings of some documents by term, with the factor of each that no query changes."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray, norms: np.ndarray):
        order = np.argsort(terms, kind="stable")
        terms, self.docs = terms[order], docs[order]
        counts = counts[order].astype("int64")
        self.factors = (1_000_000_000 * counts) // (1000 * counts + 20 * norms[self.docs])
        self.size = len(norms)
        present, starts, sizes = np.unique(terms, return_index=True, return_counts=True)
        self.slices = dict(zip(present.tolist(), zip(starts.tolist(), (starts + sizes).tolist(), strict=True), strict=True))
        most = np.maximum.reduceat(self.factors, starts) if len(starts) else starts
        self.greatest = dict(zip(present.tolist(), most.tolist(), strict=True))

    def scores(self, terms: list[int], weights: list[int], k: int, threshold: int) -> np.ndarray:
        """Scores of the documents, exact for all that can be among the k best; 0 or too low for others.

        ``terms`` are rarest first; documents below ``threshold`` do not count.
        """
        sums = np.zeros(self.size, "int64")
        here = [(t, w) for t, w in zip(terms, weights, strict=True) if t in self.slices]
        left = sum(w * self.greatest[t] for t, w in here)
        making = True
        for term, weight in here:
            if making and left < threshold:
                making = False
            start, stop = self.slices[term]
            docs, parts = self.docs[start:stop], weight * self.factors[start:stop]
            if not making:
                old = sums[docs] > 0
                docs, parts = docs[old], parts[old]
            sums[docs] += parts
            left -= weight * self.greatest[term]
            if making and self.size >= k and left < sums.max():
                threshold = max(threshold, int(np.partition(sums, self.size - k)[self.size - k]))
        return sums


def _search(queries: list[tuple[int, list[int], list[int]]], n_docs: int, n_terms: int, k: int, shard_docs: int):
    """``queries``: number, terms rarest first, and their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for whole in batches:
            for at in range(0, whole.num_rows, shard_docs):
                batch = whole.slice(at, shard_docs)
                missing = np.array(batch.column(0).is_null())
                ids = np.array(batch.column(0).fill_null(0))
                # Whole numbers of Python: the product may pass 64 bits.
                norms = np.array([50 + 50 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], "int64")
                sizes = np.array(batch.column(2).value_lengths(), "int64")
                docs = np.repeat(np.arange(batch.num_rows), sizes)
                shard = Shard(np.array(batch.column(2).flatten()), docs, np.array(batch.column(3).flatten()), norms)
                for top, (_, terms, weights) in zip(best, queries, strict=True):
                    scores = shard.scores(terms, weights, k, top.threshold)
                    good = np.flatnonzero(scores >= top.threshold)
                    if len(good):
                        top.merge(scores[good], ids[good], missing[good])
        for top, (number, _, _) in zip(best, queries, strict=True):
            if len(top.ids):
                columns = [pa.array([number] * len(top.ids), pa.int64()), pa.array(top.ids, mask=top.missing), pa.array(top.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return run


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def _search_block(spark: SparkSession, docs: DataFrame, block: Block, k: int, shard_docs: int) -> DataFrame:
    index = saved(spark, docs.mapInArrow(_index(block.vocabulary), "doc_id long, n long, terms array<int>, counts array<int>"), "postings")
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = {r.term: r["docs"] for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("docs")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in seen.items()}
    queries = []
    for number, terms in zip(block.numbers, block.queries, strict=True):
        rare = sorted((t for t in terms if weight.get(t)), key=lambda t: (seen[t], t))
        if rare:
            queries.append((number, rare, [weight[t] for t in rare]))
    found = index.mapInArrow(_search(queries, n_docs, n_terms, k, shard_docs), "number long, doc_id long, score long")
    found = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    return _best(_best(found, ["number", "bucket"], k), ["number"], k)


def ranked_search(
    spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_col: str = "text", block_uses: int = BLOCK_USES, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` documents that score highest for each query, best first."""
    out = fresh(docs.select(F.lit(0).alias("rank"), F.lit(0).alias("doc_id"), F.lit(0).alias("score")), item_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.monotonically_increasing_id().alias("number"), F.col(item_col).alias("item_id"), F.col(query_col).cast("binary").alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    asked = saved(spark, asked.mapInArrow(_query_terms, f"number long, item_id {kind}, terms array<binary>"), "queries")
    uses = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-uses // block_uses))
    parts = []
    for b in range(blocks):
        block = Block()
        mine = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).where(F.size("terms") > 0)
        for row in mine.select("number", "terms").collect():
            block.add(row.number, [bytes(t) for t in row.terms])
        part = _search_block(spark, texts, block, k, shard_docs)
        parts.append(part if blocks == 1 else saved(spark, part, "ranked"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.join(asked.select("number", F.col("item_id").alias(out)), "number").select(out, "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
WITH cut AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents
), docs AS (
    SELECT r, doc_id, terms, len(terms) AS n FROM cut WHERE len(terms) > 0
), corpus AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs
), asked AS (
    SELECT q, item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '{_TERM}'))) AS term
    FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)
), postings AS (
    SELECT r, term, count(*) AS tf
    FROM (SELECT r, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(corpus.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term
), scored AS (
    SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * corpus.docs) // corpus.terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (r), corpus GROUP BY q, r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
