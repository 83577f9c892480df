"""Fingerprints, classifiers and archives."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
import zstandard

from procurelens.llm import fingerprints, quality, toxicity, warc
from procurelens.llm.common import table
from procurelens.session import work_dir

from edge_rows import EDGE


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    labels = np.array(labels, bool)
    n = labels.sum()
    return (order[labels].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_fingerprint_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in fingerprints.op5_fingerprints(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, n = texts[i], len(texts[i]) // 4
        edited = text[: len(text) - n] + texts[following][:n]
        own, moved, nxt = (fingerprints.added(fingerprints.vectors(fingerprints.paragraphs(t))) for t in (text, edited, texts[following]))
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprints.as_text(own), fingerprints.as_text(moved))
        assert r["near_edited"] == fingerprints.likeness(own, moved) and r["near_next"] == fingerprints.likeness(own, nxt)
    long = [r for r in rows.values() if r["n_chars"] > 400]
    assert np.median([r["near_edited"] for r in long]) > 0.6 > 0.2 > np.median([r["near_next"] for r in long])


def test_repeated_paragraphs_stay_different():
    """As many copies as would bring a narrow sum round; by plain numbers."""
    def plain(text):
        digests = [hashlib.blake2b(p.encode(), digest_size=64).digest() for p in text.replace(". ", ".\n").split("\n") if p]
        numbers = [sum(int.from_bytes(d[8 * i : 8 * i + 8], "little") for d in digests) % 2**64 for i in range(8)]
        signs = [sum(1 if d[i // 8] >> (7 - i % 8) & 1 else -1 for d in digests) % 2**32 for i in range(256)]
        return (b"".join(x.to_bytes(8, "little") for x in numbers) + b"".join(x.to_bytes(4, "little") for x in signs)).hex()

    found = set()
    for word, n in (("alpha", 32768), ("beta", 32768), ("alpha", 65536), ("alpha", 70000), ("beta", 70000)):
        got = fingerprints.added(fingerprints.vectors(fingerprints.paragraphs(f"{word}. " * n)))
        found.add(fingerprints.as_text(got))
        assert n > 40000 or fingerprints.as_text(got) == plain(f"{word}. " * n)
    assert len(found) == 5 and fingerprints.as_text(fingerprints.added(fingerprints.vectors([]))) not in found
    one, two = (fingerprints.added(fingerprints.vectors(["a"] * n + ["b"] * m)) for n, m in ((70000, 0), (35000, 35000)))
    assert 0.4 < fingerprints.likeness(one, two) < 0.75 and fingerprints.likeness(one, one * 0) == 0


def test_fingerprints_are_homomorphic():
    parts = [f"paragraph {i % 9}" for i in range(30)]
    whole = fingerprints.added(fingerprints.vectors(parts))
    shuffled = random.Random(1).sample(parts, len(parts))
    assert (whole == fingerprints.added(fingerprints.vectors(shuffled))).all()
    grown = fingerprints.insert(whole, ["new one"])
    assert (grown != whole).any() and (fingerprints.delete(grown, ["new one"]) == whole).all()


@pytest.mark.parametrize("partitions", [1, 7])
def test_fingerprint_edge_cases(spark, edge, empty, partitions):
    rows = fingerprints.fingerprint_table(spark, edge.repartition(partitions)).collect()
    assert len(rows) == len(EDGE)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["near_next"] == 1.0 and by_id[6]["near_next"] == 0.0
    assert fingerprints.fingerprint_table(spark, empty).count() == 0


def test_single_document_is_its_own_next(spark, docs_of):
    (row,) = fingerprints.fingerprint_table(spark, docs_of([(3, "abcdefgh")])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1.0


def test_fingerprint_answers_are_small():
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    n = 3 * fingerprints.ROWS
    batch = pd.DataFrame({"range": 0, "borrowed": [False] * n + [True], "doc_id": [*range(n), 0], "text": "One. Two."})
    frames = list(fingerprints._answers(columns)(iter([batch.iloc[:100], batch.iloc[100:]])))
    assert max(map(len, frames)) <= fingerprints.ROWS
    assert [i for f in frames for i in f["doc_id"]] == list(range(n))


def _held_out(spark, rows, label, big_dir):
    known = {r["doc_id"]: r[label] for r in table(spark, big_dir, "labels").collect()}
    rows = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    return [r["score"] for r in rows], [known[r["doc_id"]] for r in rows]


def test_toxicity_on_held_out_rows(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.1")
    rows = toxicity.op6_toxicity(spark, big).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert _auc(*_held_out(spark, rows, "toxic", big)) > 0.85


def test_misspellings_share_subwords():
    rng = random.Random(4)
    calm = [f"calm{rng.randrange(200)}" for _ in range(4000)]
    bags, labels = [], []
    for i in range(300):
        words = rng.sample(calm, 40) + (["wretchedly", "wretched"] if i % 2 else [])
        bags.append(toxicity.bag_of(" ".join(words)))
        labels.append(i % 2)
    model = toxicity.train(bags, np.array(labels), np.ones(300, "float32"))
    text = " ".join(calm[:40])
    plain, odd = model.score_batch([text, text + " wretchedd wretcheed"], {})
    assert odd > 0.7 > 0.5 > plain


def test_rare_words_are_trained():
    """Each of five words marks four documents of a class of twenty, and none of them is in more."""
    rng = random.Random(8)
    calm = [f"calm{rng.randrange(200)}" for _ in range(4000)]
    marks = ["zyxgrub", "quovkelp", "jimflod", "wratchub", "ghysnop"]
    texts = [" ".join(rng.sample(calm, 40) + ([marks[i // 2 % 5]] * 3 if i % 2 else [])) for i in range(40)]
    model = toxicity.train([toxicity.bag_of(t) for t in texts], np.arange(40) % 2, np.ones(40, "float32"))
    plain = " ".join(calm[:40])
    scores = model.score_batch([plain, *(f"{plain} {m} {m} {m}" for m in marks)], {})
    assert scores[1:].min() > 0.7 > scores[0] + 0.1


def test_toxicity_edge_cases(spark, edge, empty, sf_dir):
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(table(spark, sf_dir, "documents"), labels)
    assert toxicity.scored(edge, model).count() == len(EDGE)
    assert toxicity.scored(empty, model).count() == 0
    none = toxicity.fit(edge, labels.limit(0))
    assert all(r["score"] < 1e-9 for r in toxicity.scored(edge, none).collect())
    kept = toxicity.clean_documents(edge, labels.limit(0))
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


def test_quality_on_held_out_rows(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    rows = quality.op8_quality(spark, big).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert _auc(*_held_out(spark, rows, "quality", big)) > 0.97


def test_scale_is_that_of_all_documents(spark, sf_dir, empty):
    texts = [r.text for r in table(spark, sf_dir, "documents").collect()]
    rows = np.array([quality.features(t) for t in texts], "float64")
    mean, spread = quality.scale_of(table(spark, sf_dir, "documents").repartition(5))
    np.testing.assert_allclose(mean, rows.mean(axis=0), atol=1e-9)
    np.testing.assert_allclose(spread, rows.std(axis=0), atol=1e-6)
    assert quality.scale_of(empty) is None


def test_quality_edge_cases(spark, edge, empty, sf_dir):
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(table(spark, sf_dir, "documents"), labels)
    assert quality.scored(edge, model).count() == len(EDGE)
    assert quality.scored(empty, model).count() == 0
    assert {r["predicted"] for r in quality.scored(edge, quality.fit(edge, labels.limit(0))).selectExpr("score > 0.5 AS predicted").collect()} == {False}


def test_non_negative_risk_finds_hidden_negatives():
    rng = np.random.default_rng(0)
    positive = rng.normal(1, 1, (800, 3))
    unlabelled = np.vstack([rng.normal(1, 1, (800, 3)), rng.normal(-1, 1, (800, 3))])
    model = quality.train(positive.astype("float32"), unlabelled.astype("float32"), 0.5, steps=800)
    scores = model.score(unlabelled.astype("float32"))
    assert _auc(scores, [1] * 800 + [0] * 800) > 0.95


@pytest.fixture
def pages(spark):
    rows = [(4, "http://a/ü b", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "u", None), (7, "u\r\nX: y", ""),
            (None, "n", "<p>same</p>"), (3, "r\r\n\r\nWARC/1.1", "own\r\n\r\nWARC/1.1\r\n"), (3, "r", "own\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark, pages):
    rows = warc.read_archives(spark, warc.write_archives(spark, pages)).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    same, nothing, own = "<p>same</p>", "", "own\r\n\r\nWARC/1.1\r\n"
    want = [(4, 11, digest(same), "revisit", 2), (2, 11, digest(same), "response", None), (None, 11, digest(same), "revisit", 2),
            (9, 0, digest(nothing), "revisit", 7), (7, 0, digest(nothing), "response", None),
            (3, len(own), digest(own), "response", None), (3, len(own), digest(own), "response", None)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    small = warc.write_archives(spark, pages.repartition(2), bundle_bytes=10)
    bundles = small.select("bundle").distinct().count()
    read = warc.read_archives(spark, small)
    assert bundles > 2 and read.rdd.getNumPartitions() == bundles and sorted(read.collect(), key=str) == sorted(rows, key=str)
    larger = warc.read_archives(spark, warc.write_archives(spark, pages, least_bytes=12)).collect()
    assert {r["record_type"] for r in larger} == {"response"}
    assert warc.read_archives(spark, warc.write_archives(spark, pages.limit(0))).count() == 0


def test_one_record_from_its_frame(spark, pages):
    row = warc.write_archives(spark, pages).where("page_id = 3").first()
    data = warc.read_record(*(row[c] for c in ("bundle", "frame_at", "frame_size", "offset", "size")))
    ((headers, block),) = warc.parse(data)
    assert headers["WARC-Record-ID"] == "<urn:page:3>" and block.endswith(b"own\r\n\r\nWARC/1.1\r\n")


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    bundle = warc.Bundle()
    for i in range(5):
        bundle.add(i, warc.record(i, "u", bytes([97 + i]) * 200_000, None))
    folder = warc._uri(work_dir(spark, "bundle"))
    index = bundle.finish(folder, "x.warc.zst")
    data = open(f"{folder}/x.warc.zst".removeprefix("file://"), "rb").read()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read().count(b"WARC-Type: response") == 5
    assert len(warc.read_seek_table(data)) == index["frame"].nunique() > 1
