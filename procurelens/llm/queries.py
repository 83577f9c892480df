"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from procurelens.llm import (
    exact_dedup,
    fingerprints,
    host_trust,
    lexical_search,
    mixing,
    packing,
    periodic_runs,
    quality,
    sentence_dedup,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_source_mixing": mixing.op2_source_mixing,
    "op3_simhash": simhash.op3_simhash,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_warc": warc.op7_warc,
    "op8_quality": quality.op8_quality,
    "op9_sentence_spans": sentence_dedup.op9_sentence_spans,
    "op10_packing": packing.op10_packing,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_host_trust": host_trust.op12_host_trust,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op2_source_mixing": mixing.OP2_SQL,
    "op7_warc": warc.OP7_SQL,
    "op11_lexical_search": lexical_search.OP11_SQL,
    "op12_host_trust": host_trust.OP12_SQL,
}
