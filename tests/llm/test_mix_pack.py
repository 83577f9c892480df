"""Mixing, packing and the pipeline."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from procurelens.llm import mixing, packing
from procurelens.llm.common import saved, table

from edge_rows import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(5, 2, 1)):
    """Water-filling in a loop, sources in code-point order with null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        opened = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / opened > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else rest * weight[s] / opened for s in names}
        full |= over


def test_mix_meets_targets(spark, sf_dir):
    rows = mixing.op2_source_mixing(spark, sf_dir).collect()
    docs = {r["doc_id"]: r for r in table(spark, sf_dir, "documents").collect()}
    sizes = defaultdict(int)
    for d in docs.values():
        sizes[d["source"]] += len(WORD.findall(d["text"] or ""))
    targets, taken = _targets(sizes), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == len(WORD.findall(docs[r["doc_id"]]["text"] or "")) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source], abs=1e-3) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 1


def test_schedule_is_gapless_per_source_and_spread(spark):
    targets = spark.createDataFrame(
        [(0, "a", 9000, 9000.0, 9000), (1, "b", 900, 900.0, 900), (2, "c", 5, 5.0, 5), (3, "d", 0, 0.0, 0)],
        "sid int, source string, source_size long, target double, quota long",
    )
    slots = [tuple(r) for r in mixing.schedule(spark, targets, 10).collect()]
    assert len({s for s, _, _ in slots}) == len(slots) == 991
    for sid, blocks in ((0, 900), (1, 90), (2, 1)):
        assert sorted(r for _, s, r in slots if s == sid) == list(range(blocks))
    early = [s for _, s, _ in sorted(slots)[:200]]
    assert 14 <= early.count(1) <= 23


def test_van_der_corput(spark):
    got = [r[0] for r in spark.range(4).select(mixing.van_der_corput(F.col("id"), 4)).collect()]
    assert got == [0, 8, 4, 12]


def test_mix_edge_cases(spark, edge, empty):
    rows = mixing.taken_words(*mixing.mix(spark, edge)).collect()
    assert len(rows) == len(EDGE)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    mixed = mixing.mixed_documents(spark, edge)
    assert mixed.columns == edge.columns and all(r["text"].strip() for r in mixed.collect())
    assert mixing.mixed_documents(spark, empty).count() == 0
    assert mixing.taken_words(*mixing.mix(spark, empty)).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, docs_of):
    docs = docs_of([(i, f"w{i}\t" + " x  y" * (i % 7), "abc"[i % 3]) for i in range(60)])
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(*mixing.mix(spark, docs)).collect()}
    words = defaultdict(int)
    for r in mixing.mixed_documents(spark, docs).collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert dict(words) == {i: n for i, n in taken.items() if n}


def test_rows_that_share_an_id_are_taken_each_on_its_own(spark, docs_of):
    texts = ["", "a b c", "d e f g h", "d e f g h", "i j"]
    docs = docs_of([(i, t, s) for s in ("s", "t") for i in (None, 4) for t in texts])
    words = defaultdict(int)
    for r in mixing.mixed_documents(spark, docs).collect():
        words[r["doc_id"], r["source"]] += len(WORD.findall(r["text"]))
    want = defaultdict(int)
    for r in mixing.taken_words(*mixing.mix(spark, docs)).collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    assert dict(words) == {k: n for k, n in want.items() if n}
    assert (words[None, "s"] + words[4, "s"], words[None, "t"] + words[4, "t"]) == (42, 17)  # 60 words by 5 to 2, whole words


def _check_packing(rows, texts, sequence=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= sequence
    return sequences


def test_packing_query(spark, sf_dir):
    rows = packing.op10_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    assert {r["doc_id"] for r in rows} == set(texts)
    sequences = _check_packing(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) * 4096 < tokens * 1.02 + 4096


def test_best_fit_takes_the_tightest_sequence():
    at, offset = packing.best_fit(np.array([7, 6, 4, 3, 2, 2]), 10)
    assert at.tolist() == [0, 1, 1, 0, 2, 2] and offset.tolist() == [0, 0, 6, 7, 0, 2]
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 4097, 500))[::-1]
    at, _ = packing.best_fit(lengths, 4096)
    open_room, want = {}, []
    for n in lengths.tolist():
        fits = [(room, s) for s, room in open_room.items() if room >= n]
        room = min(fits)[0] if fits else None
        want.append(room)
        s = next((s for r, s in fits if r == room), len(open_room))
        open_room[s] = open_room.get(s, 4096) - n
    assert len(set(at.tolist())) == len(open_room)


@pytest.mark.parametrize(
    "text",
    ["", "I'll don't İSTANBUL ǅ ſ 'Re'd", "tab\u0085a\xa0b ½ ² ª º ß", "a<|endoftext|>b", "😀 Σας é", "a\x1cb", "_x__ y-z–— „q“ €5"],
)
def test_word_encoder_gives_the_ids_of_the_whole_text(text):
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.ids(text) == encoder.whole(text)


def test_other_tokenizers_go_through_whole_texts(tmp_path):
    from tokenizers import Tokenizer, normalizers

    text = "Don't  shout, it's 1999 <|startoftext|> and tab\there"
    own = public_tokenizers.path("word_bpe_49k.json")
    assert packing.WordEncoder(own).by_words
    other = packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_words and other.ids("Hello  World") == other.whole("Hello  World")
    # The same file with a step less, a plain added token, or a wish to cut texts short.
    cased, added, short = (Tokenizer.from_file(own) for _ in range(3))
    cased.normalizer = normalizers.NFC()
    added.add_tokens(["shout"])
    short.enable_truncation(3)
    for name, tokenizer, by_words in (("cased", cased, False), ("added", added, False), ("short", short, True)):
        tokenizer.save(str(tmp_path / name))
        encoder = packing.WordEncoder(str(tmp_path / name))
        tokenizer.no_truncation()
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.by_words == by_words and encoder.ids(text) == want


def test_packing_edge_cases(spark, edge, empty):
    rows = packing.pack_documents(spark, edge).collect()
    assert sum(r["start"] == 0 for r in rows) == len(EDGE)
    assert all(r["doc_tokens"] == 1 for r in rows if r["doc_id"] in (5, 6, 10))
    assert packing.pack_documents(spark, empty).count() == 0
    full = [r for r in packing.pack(saved(spark, packing.token_pieces(edge, sequence=4), "t"), 4).collect() if r["length"] == 4]
    assert full and all(r["offset"] == 0 and r["padding"] == 0 for r in full)


def test_pipeline_stages(spark, sf_dir):
    """Each stage against plain Python on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(saved(spark, stage(spark, kept[-1], sf_dir), name))
    assert all(k.columns == columns for k in kept[:-1])
    texts = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept[:-1]]
    clean, exact, near, mixed = texts[1:]
    assert 0.7 * len(texts[0]) < len(clean) < len(texts[0])
    largest = {}
    for i, t in clean:
        largest[t] = max(largest.get(t, -1), i)
    assert sorted(exact) == sorted((i, t) for t, i in largest.items())
    assert set(near) < set(exact)
    assert {i for i, _ in mixed} <= {i for i, _ in near}
    tokens = sum(r["length"] for r in kept[-1].collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed)
    assert corpus_pipeline.run(spark, sf_dir).agg(F.sum("length")).first()[0] == tokens
