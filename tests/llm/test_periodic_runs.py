import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from procurelens.llm import periodic_runs as pr

WS = " \t\n\x0b\f\r"


def plain_runs(seq, least):
    """(start, length, period) of all runs, by comparing words one by one."""
    found = {}
    for q in range(1, len(seq) // 2 + 1):
        i = 0
        while i + q < len(seq):
            j = i
            while j + q < len(seq) and seq[j] == seq[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def runs_of(sequences, least):
    found = [x.tolist() for x in pr.batch_runs([np.array(s, "int64") for s in sequences], least)]
    rows = list(zip(*found, strict=True))
    return [[r[1:] for r in rows if r[0] == i] for i in range(len(sequences))]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), max_size=30), st.lists(st.integers(0, 1), min_size=1, max_size=7), st.integers(0, 6))
        .map(lambda x: x[0] + x[1] * x[2]),
        max_size=6,
    ),
    st.sampled_from([2, 5, 12]),
)
def test_runs_match_plain_comparison(sequences, least):
    assert runs_of(sequences, least) == [plain_runs(s, least) for s in sequences]


def test_runs_within_runs_and_long_ones():
    inner = ([0, 1] * 7 + [2]) * 9
    fibonacci = [0]
    for _ in range(14):
        fibonacci = [x for s in fibonacci for x in ((0, 1) if s == 0 else (0,))]
    sequences = [inner, fibonacci, [4] * 5000, list(range(2000)) * 3 + [7], []]
    assert runs_of(sequences, 12) == [plain_runs(s, 12) for s in sequences]


def test_chunks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(3)
    sequences = [np.concatenate([rng.integers(0, 2, 50), np.tile(rng.integers(0, 3, 9), 6)]) for _ in range(20)]
    whole = runs_of(sequences, 12)
    monkeypatch.setattr(pr, "CHUNK", 37)
    assert runs_of(sequences, 12) == whole


def test_common_symbols_of_a_grammar():
    rng = np.random.default_rng(1)
    text = np.concatenate([np.tile(rng.integers(0, 3, 40), 5), [9], rng.integers(0, 2, 200), [10]])
    a, b = rng.integers(0, len(text), 2000), rng.integers(0, len(text), 2000)
    a, b = a[a != b], b[a != b]
    def plain(i, j):
        k = 0
        while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        return k
    low, high = np.minimum(a, b), np.maximum(a, b)
    assert pr.Grammar(text).common(low, high).tolist() == [plain(i, j) for i, j in zip(low, high, strict=True)]


def expected(doc_id, text):
    words = [w for w in __import__("re").split(f"[{WS}]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in pr.op13_periodic_runs(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len(d.text or "") < 40_000]
    assert len(short) > 150 and all(got[d.doc_id] == expected(d.doc_id, d.text) for d in short)
    assert sum(1 for d in short if got[d.doc_id][0]) > 10


def test_edge_rows(spark, edge, empty, docs_of):
    got = pr.periodic_runs(edge).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_runs, r.length, r.collapsed) for r in got) == [
        ("10", 0, 0, None, ""), ("11", 2, 0, None, "a b"), ("12", 3, 0, None, "ü€😀 <|endoftext|> x"), ("5", 0, 0, None, ""),
        ("6", 0, 0, None, ""), ("7", 2, 0, None, "a b"), ("8", 2, 0, None, "a b"), ("8", 2, 0, None, "a b"),
        ("9", 3000, 1, 3000, "word"), ("None", 0, 0, None, ""), ("None", 2, 0, None, "a b")]
    assert pr.periodic_runs(empty).collect() == []
    (row,) = pr.periodic_runs(docs_of([(1, "x a b c d\xa0e a b c d\xa0e y", "s")]), least=4).collect()
    assert (row.runs, row.collapsed) == ("1,8,4\n", "x a b c d\xa0e y")
