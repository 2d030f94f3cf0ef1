"""The registered queries of the subpackage: one per operator (the pipeline is added by ``corpus_pipeline``)."""

from __future__ import annotations

from . import (q_compressmodel, q_decontaminate, q_langid, q_neardup, q_packing, q_pii, q_quality, q_repair, q_substrings,
               q_tokencount, q_urlfilter, q_warc, q_whitening)

_QUERIES = {
    "op1_token_counts": (q_tokencount.op1_token_counts, None),
    "op2_minhash_near_dedup": (q_neardup.op2_minhash_near_dedup, q_neardup.SQL),
    "op3_benchmark_decontamination": (q_decontaminate.op3_benchmark_decontamination, q_decontaminate.SQL),
    "op4_language_id": (q_langid.op4_language_id, None),
    "op5_substring_dedup": (q_substrings.op5_substring_dedup, q_substrings.SQL),
    "op6_quality_rules": (q_quality.op6_quality_rules, q_quality.SQL),
    "op7_warc": (q_warc.op7_warc, q_warc.SQL),
    "op8_packing": (q_packing.op8_packing, None),
    "op9_pii": (q_pii.op9_pii, q_pii.SQL),
    "op10_url_filters": (q_urlfilter.op10_url_filters, q_urlfilter.SQL),
    "op11_conversation_repair": (q_repair.op11_conversation_repair, q_repair.SQL),
    "op12_quality_classifier": (q_compressmodel.op12_quality_classifier, None),
    "op13_embedding_whitening": (q_whitening.op13_embedding_whitening, None),
}


def queries():
    return {name: build for name, (build, _) in _QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
