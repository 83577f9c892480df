"""The order of the mix against a plain loop over van der Corput points."""

from collections import defaultdict

import numpy as np
import pytest

from procurelens.llm import mixing


def plain_slots(quotas, block):
    """(source number, block) at each slot, point by point."""
    blocks = [-(-q // block) for q in quotas]
    total, slots, nth = sum(quotas), [], [0] * len(quotas)
    ends = np.cumsum(quotas)
    edges = [(int((e - q) / float(total) * 2**40), int(e / float(total) * 2**40)) for e, q in zip(ends.tolist(), quotas, strict=True)]
    for slot in range(sum(blocks)):
        point = int(f"{slot:040b}"[::-1], 2)
        source = next(i for i, (low, high) in enumerate(edges) if low <= point < high)
        if nth[source] < blocks[source]:
            slots.append((slot, source, nth[source]))
        nth[source] += 1
    late = sorted((k, i) for i in range(len(quotas)) for k in range(min(nth[i], blocks[i]), blocks[i]))
    return slots + [(sum(blocks) + j, i, k) for j, (k, i) in enumerate(late)]


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_follow_the_points(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, "w " * int(rng.integers(0, 90)), "abcd"[int(rng.integers(0, 4))], 1) for i in range(120)] + [(None, "x y z", None, 1), (None, None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, Slot int")
    got = mixing.mixed_blocks(spark, docs, block_words=32).collect()
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    placed, pieces = mixing.mix(spark, docs, block_words=32)
    quotas = {r.sid: (r.source, r.quota) for r in placed.select("sid", "source", "quota").distinct().collect()}
    sources = [quotas[i] for i in range(len(quotas))]
    want = plain_slots([q for _, q in sources], 32)
    words, source_of = defaultdict(int), {}
    for r in got:
        words[r.slot] += r.words
        assert source_of.setdefault(r.slot, r.source) == r.source
    assert source_of == {slot: sources[i][0] for slot, i, _ in want}
    assert dict(words) == {slot: min(32, sources[i][1] - 32 * k) for slot, i, k in want}
    first = {}
    for r in got:
        if r.doc_id is not None:
            first.setdefault(r.doc_id, r.slot)
    taken = {r.doc_id: r.first_slot for r in mixing.taken_words(placed, pieces).where("doc_id IS NOT NULL AND taken > 0").collect()}
    assert taken == first
    # Any stretch of the schedule holds about the shares of the whole.
    half = [i for slot, i, _ in want if slot < len(want) // 2]
    total = sum(q for _, q in sources)
    assert all(abs(half.count(i) / len(half) - q / total) < 0.1 for i, (_, q) in enumerate(sources))
