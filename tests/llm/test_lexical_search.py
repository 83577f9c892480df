import math
import re
from collections import Counter

import numpy as np
import pytest

from procurelens.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k):
    """Rows (item, rank, doc_id, score) by scoring every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 100 - 50 + (50 * bag.total() * len(bags)) // total
            score = 0
            for t in set(terms(text)):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def search(spark, docs, items, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, Score string").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    found = ls.ranked_search(spark, docs, items, **options)
    assert [c.lower() for c in found.columns] == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=key)


def random_texts(rng, n, words):
    return [" ".join(rng.choice(words, rng.integers(0, 25), p=np.arange(len(words), 0, -1) / sum(range(len(words) + 1)))) for _ in range(n)]


@pytest.mark.parametrize("shard,block_uses", [(8192, 200_000), (7, 200_000), (11, 9)])
def test_random_texts_match_plain_scoring(spark, shard, block_uses):
    rng = np.random.default_rng(shard)
    words = [f"w{i}" for i in range(40)] + ["Ünder", "x_Y", "don't"]
    docs = list(enumerate(random_texts(rng, 150, words)))
    docs += [(i + 1000, t) for i, t in docs[:20]]  # ties
    items = list(enumerate(random_texts(rng, 6, words)))
    assert search(spark, docs, items, k=5, block_uses=block_uses, shard_docs=shard) == sorted(plain_search(docs, items, 5), key=key)


def shard_of(rng, n, n_terms):
    terms, docs, counts = [], [], []
    for d in range(n):
        own = rng.choice(n_terms, rng.integers(0, 8), replace=False, p=np.arange(1, n_terms + 1) ** 2.0 / sum(np.arange(1, n_terms + 1) ** 2.0))
        terms += own.tolist()
        docs += [d] * len(own)
        counts += rng.integers(1, 4, len(own)).tolist()
    return ls.Shard(np.array(terms), np.array(docs), np.array(counts), rng.integers(50, 200, n))


def test_accumulators_are_limited_and_the_best_stay_exact():
    rng = np.random.default_rng(9)
    limited = 0
    for _ in range(60):
        shard = shard_of(rng, 300, 30)
        chosen = rng.choice(30, 9, replace=False).tolist()
        weights = {t: int(rng.integers(1, 50)) if t > 20 else int(rng.integers(500, 2000)) for t in chosen}
        chosen.sort(key=lambda t: -weights[t])
        exact = np.zeros(300, "int64")
        for t in chosen:
            start, stop = shard.slices.get(t, (0, 0))
            exact[shard.docs[start:stop]] += weights[t] * shard.factors[start:stop]
        got = shard.scores(chosen, [weights[t] for t in chosen], 10, 1)
        kth = np.sort(exact)[-10]
        assert (got[exact >= max(kth, 1)] == exact[exact >= max(kth, 1)]).all()
        assert (got <= exact).all()
        limited += int((got > 0).sum() < (exact > 0).sum())
    assert limited > 5


def test_edge_rows(spark, edge, empty):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(1, "A word"), (1, "b"), (None, "endoftext b"), (3, None), (4, " ... "), (5, "x")]
    assert search(spark, docs, items, k=3) == sorted(plain_search(docs, items, 3), key=key)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []
    assert search(spark, [(1, None), (2, "")], items) == []


def test_long_texts_and_repeated_terms(spark):
    docs = [(1, "alpha " * 50_000 + "beta"), (2, "beta alpha"), (3, "gamma " * 1000), (4, "delta")]
    items = [(7, "alpha alpha beta BETA"), (8, "gamma delta")]
    assert search(spark, docs, items) == sorted(plain_search(docs, items, 50), key=key)
