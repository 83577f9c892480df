"""Sentence spans against a plain version, whole tables."""

import re
from collections import defaultdict

import numpy as np
import pytest

from procurelens.llm import sentence_dedup as sd

MASK = (1 << 64) - 1
WS = "\t\n\x0b\x0c\r "


def mixed(x):
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def unspaced(c):
    return any(low <= ord(c) <= high for low, high in sd.UNSPACED)


def plain_sentences(text):
    """(start, end, words) of each sentence, word by word."""
    words = []  # (start, end)
    for stretch in re.finditer(r"[^\t\n\x0b\x0c\r ]+", text):
        start = stretch.start()
        for i in range(stretch.start(), stretch.end()):
            if i > start and (unspaced(text[i]) or unspaced(text[i - 1])):
                words.append((start, i))
                start = i
        words.append((start, stretch.end()))
    own = [sum(mixed(ord(c) + (k << 32)) for k, c in enumerate(text[a:b])) & MASK for a, b in words]
    value = []
    for i, (a, b) in enumerate(words):
        after = words[i + 1][0] if i + 1 < len(words) else None
        ends = text[b - 1] in sd.MARKS or after is None or any(c in "\n\x0b\x0c\r" for c in text[b:after])
        value.append(0 if ends else mixed((own[i] * 0x9E3779B97F4A7C15 + (own[i - 1] if i else 0)) & MASK) | 1)
    cuts = []
    for i, v in enumerate(value):
        # The start of the text counts as the smallest of all.
        left = [value[j] if j >= 0 else 0 if j == -1 else MASK for j in range(i - sd.REACH, i)]
        right = [value[j] if j < len(value) else MASK for j in range(i + 1, i + 1 + sd.REACH)]
        if v == 0 or (all(v < x for x in left) and all(v <= x for x in right)):
            cuts.append(i + 1)
    out, before = [], 0
    for cut in cuts:
        if cut - before > sd.MAX_SENTENCE_WORDS:
            for more in range(before + sd.REPEAT_WORDS, cut, sd.REPEAT_WORDS):
                out.append(more)
        out.append(cut)
        before = cut
    sentences, start, before = [], 0, 0
    for cut in out:
        sentences.append((start, words[cut - 1][1], cut - before))
        start, before = words[cut - 1][1], cut
    return sentences


def plain(rows):
    """Rows of without_repeats from (doc_id, text) rows."""
    cut = [(i, t or "", plain_sentences(t or "")) for i, t in rows]
    places = defaultdict(set)
    for doc_id, text, sentences in cut:
        runs = []
        for at in range(len(sentences)):
            stop, words = at, 0
            while stop < len(sentences) and (stop < at + sd.SPAN or words < sd.MIN_WORDS):
                words += sentences[stop][2]
                stop += 1
            if stop >= at + sd.SPAN and words >= sd.MIN_WORDS:
                runs.append((at, stop))
        if sentences and not runs:
            runs = [(0, len(sentences))]
        for at, stop in runs:
            key = tuple(text[a:b].lstrip(WS) for a, b, _ in sentences[at:stop])
            places[key].add((doc_id is not None, doc_id or 0, text, at, stop))
    gone = defaultdict(set)
    for found in places.values():
        ids = {p[:2] for p in found}
        first = min(p[:2] for p in found)
        same = [p for p in found if p[:2] == first]
        assert len({p[2] for p in same}) == 1 or len(ids) == 1  # the order of equal ids with other texts is by a hash
        keep = min(same, key=lambda p: p[3])
        for p in found - {keep}:
            gone[p[:3]].add((p[3], p[4]))
    out = []
    for doc_id, text, sentences in cut:
        spans = gone[(doc_id is not None, doc_id or 0, text)]
        covered = {i for at, stop in spans for i in range(at, stop)}
        kept = "".join(text[a:b] for i, (a, b, _) in enumerate(sentences) if i not in covered)
        out.append((doc_id, len(sentences), len(covered), len(spans), kept))
    return out


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


def test_query_matches_a_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, sd.op9_sentence_spans(spark, sf_dir).collect()), key=key)
    assert got == sorted(plain(docs), key=key)
    assert sum(r[2] > 0 for r in got) > 10


@pytest.mark.parametrize("most_bytes", [sd.FILTER_BYTES, 0])
def test_unaligned_and_repeated_rows(spark, most_bytes):
    rng = np.random.default_rng(11)
    word = lambda: f"w{rng.integers(400)}"
    passage = " ".join(word() for _ in range(60))
    marks = [" ", " ", " ", ". ", "\n", "。", "! \t"]
    rows = []
    for i in range(60):
        words = [word() + marks[rng.integers(len(marks))] for _ in range(rng.integers(0, 60))]
        if i % 3 == 0:
            words.insert(rng.integers(0, len(words) + 1), passage + " ")
        rows.append((i, "".join(words)))
    rows += [rows[3], rows[3], (None, None), (70, ""), (71, None), (72, "x y z."), (73, "x y z."), (None, "x y z."), (74, " x y z. "), (75, "same " * 50)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int").repartition(4)
    got = sorted(map(tuple, sd.without_repeats(spark, frame, most_bytes=most_bytes).collect()), key=key)
    assert got == sorted(plain(rows), key=key)


def test_passages_of_just_over_fifty_words_go(spark):
    """Of a passage put at unaligned places, nine words in ten go from all but its first document."""
    rng = np.random.default_rng(12)
    word = lambda: f"w{rng.integers(1 << 40)}"
    caught = []
    for case in range(40):
        passage = [word() + ("." if case % 2 and rng.random() < 0.1 else "") for _ in range(52)]
        rows = [(k, " ".join([word() for _ in range(rng.integers(20, 90))] + passage + [word() for _ in range(40)])) for k in range(2)]
        kept = set(next(r[4] for r in plain(rows) if r[0] == 1).split())
        caught.append(np.mean([w not in kept for w in passage]))
    assert np.mean(np.array(caught) > 0) >= 0.9 and np.mean(caught) > 0.6


def test_filter_lets_every_repeated_hash_through(spark):
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    words = sd.bit_filter(spark.createDataFrame([(int(h),) for h in hashes], "h1 long"))
    assert sd.let_through(words, hashes).all()
    assert sd.let_through(words, rng.integers(-(1 << 63), (1 << 63) - 1, 20000)).mean() < 0.08
    assert sd.bit_filter(spark.createDataFrame([(int(h),) for h in hashes], "h1 long"), 100) is None
