"""Exact, near, byte and sentence duplicates against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from procurelens.llm import exact_dedup, sentence_dedup, simhash, suffix_dedup
from procurelens.llm.common import table
from procurelens.llm.components import connected_components

from edge_rows import EDGE


def _groups(spark, docs, counters=1000):
    return exact_dedup.exact_groups(spark, exact_dedup.document_digests(spark, docs), counters).collect()


def test_exact_edge_cases(spark, edge):
    rows = _groups(spark, edge)
    assert len(rows) == len(EDGE)
    by_digest = defaultdict(list)
    for i, text, _ in EDGE:
        by_digest[hashlib.sha256((text or "").encode()).hexdigest()].append(i)
    for r in rows:
        ids = by_digest[r["digest"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)


def test_heavy_split_gives_the_same_groups(spark, docs_of):
    docs = docs_of([(i, "hot" if i % 3 else f"t{i % 50}") for i in range(600)]).repartition(5)
    few, many = (sorted(map(tuple, _groups(spark, docs, c))) for c in (2, 1000))
    assert few == many
    digests = exact_dedup.document_digests(spark, docs)
    assert [r["group_size"] for r in exact_dedup.heavy_winners(digests, 2).collect()] == [400]


def test_summary_keeps_frequent_digests():
    counts = pd.Series({"a": 50, **{f"x{i}": 1 for i in range(100)}})
    assert list(exact_dedup.reduce_summary(counts, 3).index) == ["a"]


def test_drop_copies(spark, edge, empty):
    kept = exact_dedup.drop_copies(spark, edge)
    assert kept.columns == edge.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, _ in EDGE})
    assert {r["doc_id"] for r in kept.collect() if r["text"] == "a b"} == {8}
    assert exact_dedup.drop_copies(spark, empty).count() == 0
    assert _groups(spark, empty) == []


def _brute_print(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _brute_components(prints):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_query_against_brute_force(spark, sf_dir):
    rows = simhash.op3_simhash(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    ids = sorted(texts)
    prints = [_brute_print(texts[i]) for i in ids]
    roots = _brute_components(prints)
    least = {}
    for i, root in zip(ids, roots, strict=True):
        least[root] = min(least.get(root, i), i)
    want = {i: (f"{p:016x}", least[root]) for i, p, root in zip(ids, prints, roots, strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("cap", [20_000, 8])
def test_links_connect_like_brute_force(spark, cap):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 6)
    prints = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(60):
            p = c
            for b in rng.choice(63, rng.integers(1, 5), replace=False).tolist():
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(spark, simhash.fingerprint_links(spark, frame, cap=cap)).collect()}
    brute = _brute_components(prints)
    got = [roots.get(p, p) for p in prints]
    assert len(set(zip(got, brute, strict=True))) == len(set(got)) == len(set(brute))


def test_simhash_edge_cases(spark, edge, empty):
    rows = simhash.near_groups(spark, edge).collect()
    assert len(rows) == len(EDGE)
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {5}
    assert simhash.near_groups(spark, empty).count() == 0
    kept = simhash.drop_near_copies(spark, edge)
    assert kept.columns == edge.columns
    assert 7 in [r["doc_id"] for r in kept.collect()]


def test_near_copies_that_share_an_id_leave_one(spark, docs_of):
    one, other = "a b c d e f g h", "i j k l m n o p"
    docs = docs_of([(None, one), (None, one), (None, other), (3, other), (3, "q r s t u v"), (1, "q r s t u v")])
    kept = [(r["doc_id"], r["text"]) for r in simhash.drop_near_copies(spark, docs).collect()]
    assert sorted(kept, key=str) == [(1, "q r s t u v"), (3, other), (None, one)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    roots = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in roots} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def _brute_bytes(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(b, "uint8")[~gone])
        spans = int((np.diff(gone.astype("int8"), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("length", "gram", "stride", "cap"), [(400, 64, 50, 2000), (60, 16, 10, 4)])
def test_repeated_bytes_against_brute_force(spark, sf_dir, docs_of, length, gram, stride, cap):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    rows += [(i, t) for i, t, _ in EDGE] + [(900, rows[3][1] + "zz"), (901, "ab" * 700), (902, rows[0][1][:500])]
    got = suffix_dedup.without_repeated_bytes(spark, docs_of(rows), length=length, gram=gram, stride=stride, cap=cap)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_bytes(rows, length)


def test_repeated_bytes_of_nothing(spark, empty):
    assert suffix_dedup.without_repeated_bytes(spark, empty).count() == 0


def test_merged_transforms_sort_all_suffixes():
    """The interleave of three shards groups suffixes as sorting all of them together does."""
    rng = np.random.default_rng(1)
    parts = [rng.integers(97, 99, n).astype("uint8") for n in (300, 200, 100)]
    masks = suffix_dedup.repeated_starts(parts, length=16, stride=4, shard_bytes=150)
    count = Counter(bytes(p[s : s + 16]) for p in parts for s in range(len(p) - 15))
    for p, mask in zip(parts, masks, strict=True):
        assert mask.tolist() == [count[bytes(p[s : s + 16])] > 1 for s in range(len(p) - 15)]


def _starts(parts, length):
    count = Counter(bytes(p[s : s + length]) for p in parts for s in range(len(p) - length + 1))
    return [[count[bytes(p[s : s + length])] > 1 for s in range(len(p) - length + 1)] for p in parts]


def test_only_chains_that_can_repeat_are_sorted(monkeypatch):
    """Contexts that share an anchor and less than a window leave nothing to merge, others little more than the window."""
    entries = []
    merge = suffix_dedup.merge_transforms

    def counted(transforms, passes):
        entries.append(sum(map(len, transforms)))
        return merge(transforms, passes)

    monkeypatch.setattr(suffix_dedup, "merge_transforms", counted)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 256, 700).astype("uint8") for _ in range(40)]
    anchor = rng.integers(0, 256, 399).astype("uint8")
    for t in texts:
        t[150 : 150 + 399] = anchor
        t[[149, 549]] = rng.choice(256, 2)
    texts = [t for i, t in enumerate(texts) if not any(t[149] == o[149] or t[549] == o[549] for o in texts[:i])]
    assert len(texts) > 20 and not np.concatenate(suffix_dedup.repeated_starts(texts)).any()
    assert sum(entries) == 0
    texts[1][149:549] = texts[0][149:549]
    masks = suffix_dedup.repeated_starts(texts)
    assert [m.tolist() for m in masks] == _starts(texts, 400) and sum(map(sum, masks)) == 2
    assert 16 <= sum(entries) <= 100


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_repeated_starts_of_odd_lengths_and_periods(letters):
    rng = np.random.default_rng(letters)
    for case in range(30):
        parts = [rng.integers(97, 97 + letters, n).astype("uint8") for n in rng.integers(12, 90, 6)]
        parts += [np.tile(parts[0][: 1 + case % 7], 9)[:40], parts[1].copy(), parts[2][5:]]
        parts = [p for p in parts if len(p) >= 12]
        masks = suffix_dedup.repeated_starts(parts, length=12, stride=(3, 4, 12)[case % 3], shard_bytes=(1, 60, 1 << 18)[case % 3])
        assert [m.tolist() for m in masks] == _starts(parts, 12)


@pytest.mark.parametrize("high", [5, 1 << 62])
def test_stable_order_of_small_and_large_keys(high):
    keys = np.random.default_rng(4).integers(0, high, 3000) // 2 * 2
    assert suffix_dedup.stable_order(keys).tolist() == np.argsort(keys, kind="stable").tolist()
    assert suffix_dedup.stable_order(keys[:0]).tolist() == []


def _passages(n, seed=8):
    rng = np.random.default_rng(seed)
    words = lambda k: rng.integers(97, 123, k).astype("uint8").tobytes().decode()
    short, long = words(50), words(90)
    return [(i if i % 7 else None, words(80) + (short if i % 2 else long) + words(80)) for i in range(n)]


def test_large_groups_do_not_meet_in_pairs(spark, docs_of, monkeypatch):
    """Contexts to be merged grow as the documents that hold a passage, also far above the cap."""
    def counted(*_):
        def run(batches):
            for batch in batches:
                yield pd.DataFrame({"doc_id": [-1], "text_key": [len(batch)], "first": [0], "last": [0]})

        return run

    monkeypatch.setattr(suffix_dedup, "_merge_groups", counted)

    def contexts(n):
        texts = docs_of(_passages(n)).selectExpr("doc_id", "xxhash64(text) AS text_key", "text")
        rows = suffix_dedup.covered_windows(spark, texts, length=60, gram=16, stride=10, cap=4)
        return rows.where("doc_id = -1").agg({"text_key": "sum"}).first()[0] or 0

    assert 0 < contexts(40) <= 4 * 40 and 0 < contexts(160) <= 4 * 160  # 751 and 12,197 when blocks met in pairs


def test_passages_far_above_the_cap_against_brute_force(spark, docs_of):
    rows = _passages(60)
    rows += [rows[1], rows[2], (500, rows[3][1]), (501, rows[4][1][:150]), (502, rows[1][1][70:140] * 3)]
    got = suffix_dedup.without_repeated_bytes(spark, docs_of(rows), length=60, gram=16, stride=10, cap=4)
    assert sorted(map(tuple, got.collect()), key=str) == _brute_bytes(rows, 60)


def test_the_length_of_a_passage_decides_in_bytes_and_not_in_words(spark, docs_of):
    """Of passages of over 50 words, those of 400 bytes go from every document, shorter ones stay."""
    rng = np.random.default_rng(3)
    words = lambda k: " ".join(rng.integers(97, 123, 6).astype("uint8").tobytes().decode() for _ in range(k))
    short, long = words(57) + ".", words(57) + ".."
    rows = [(i, f"{words(90)} {i}{p}{9 - i} {words(90)}") for i, p in enumerate([short, short, long, long, "", ""])]
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeated_bytes(spark, docs_of(rows)).collect()}
    assert (len(short), len(long)) == (399, 400)
    assert [(got[i]["n_removed"], got[i]["n_spans"]) for i in range(6)] == [(0, 0)] * 2 + [(400, 1)] * 2 + [(0, 0)] * 2
    assert [got[i]["n_bytes"] for i in range(6)] == [len(t) for _, t in rows]


def test_grams_end_with_the_whole_window():
    assert suffix_dedup.anchor_grams(400, 64) == [64, 232, 358, 400]
    assert suffix_dedup.anchor_grams(60, 60) == [60]


def test_sentence_spans_edge_cases(spark, docs_of, edge, empty):
    passage = "one two three four five six. seven eight nine ten eleven. twelve thirteen fourteen."
    docs = docs_of([(1, f"Start here now. {passage}"), (2, f"{passage} Other end."), (2, f"{passage} Other end."), (3, None)])
    rows = {r["doc_id"]: r for r in sentence_dedup.without_repeats(spark, docs).collect()}
    assert rows[1]["n_removed"] == 0 and rows[3]["n_sentences"] == 0
    assert rows[2]["kept_text"].strip() == "twelve thirteen fourteen. Other end."  # the last three words are a short span
    assert (rows[2]["n_spans"], rows[2]["n_removed"]) == (1, 2)
    assert sentence_dedup.without_repeats(spark, edge).count() == len(EDGE)
    assert sentence_dedup.without_repeats(spark, empty).count() == 0


def _invented(rng, n):
    return [f"w{rng.integers(1 << 40)}" for _ in range(n)]


def test_sentence_spans_of_short_lines(spark, docs_of):
    """Runs of short lines, characters without blanks and single repeated words are no gap."""
    rng = np.random.default_rng(5)
    lines = "\n".join(" ".join(_invented(rng, 4)) for _ in range(40))
    han = "".join(chr(0x4E00 + i) for i in rng.choice(2000, 60, replace=False).tolist())
    han = han[:25] + "。" + han[25:] + "！"
    odd = "one two three. " + "same " * 60
    docs = docs_of([(i + 10 * k, t) for k, t in enumerate((lines, han, odd)) for i in (1, 2)])
    rows = {r["doc_id"]: r for r in sentence_dedup.without_repeats(spark, docs).collect()}
    for k in (0, 10, 20):
        assert rows[k + 2]["kept_text"] == "" and rows[k + 2]["n_removed"] == rows[k + 2]["n_sentences"] > 0
    assert rows[1]["kept_text"] == lines and rows[11]["kept_text"] == han


def test_passages_share_spans_wherever_they_stand():
    """Passages of just over 50 words at unaligned places, with marks here and there or none."""
    def spans(words):
        text = " ".join(words)
        ends, counts = sentence_dedup.sentence_ends(text)
        stops, places = sentence_dedup.run_ends(counts, 2, 10), [0, *ends.tolist()]
        return {text[places[i] : places[stop]].strip() for i, stop in enumerate(stops.tolist()) if stop}

    rng = np.random.default_rng(6)
    for case in range(200):
        passage = _invented(rng, 52)
        for at in rng.choice(52, 3, replace=False).tolist() if case % 2 else ():
            passage[at] += "."
        one, other = (_invented(rng, n) + passage + _invented(rng, 90) for n in rng.integers(0, 80, 2).tolist())
        assert spans(one) & spans(other)
    repeat = ["same"] * 60
    assert spans(_invented(rng, 33) + repeat) & spans(_invented(rng, 46) + repeat + _invented(rng, 9))
