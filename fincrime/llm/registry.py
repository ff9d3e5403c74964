"""The queries of this package and their SQL."""

from __future__ import annotations

from fincrime.llm import collocations, dart_minhash, lexical_search, line_dedup, metric_join, mixing, piece_codec, quality_classifier, quality_rules, reshard, secrets, token_counts, warc

QUERIES = {
    "op1_secret_ledger": secrets.op1,
    "op2_dart_minhash": dart_minhash.op2,
    "op3_line_dedup": line_dedup.op3,
    "op4_min_cost_reshard": reshard.op4,
    "op5_shrinkage_qda": quality_classifier.op5,
    "op6_hash_threshold_mix": mixing.op6,
    "op7_warc": warc.op7,
    "op8_streaming_viterbi": piece_codec.op8,
    "op9_metric_range_join": metric_join.op9,
    "op10_quality_rules": quality_rules.op10,
    "op11_son_collocations": collocations.op11,
    "op12_presence_mask_search": lexical_search.op12,
    "op13_prefix_token_counts": token_counts.op13,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": line_dedup.op3_sql(),
        "op6_hash_threshold_mix": mixing.op6_sql(),
        "op10_quality_rules": quality_rules.op10_sql(),
        "op11_son_collocations": collocations.op11_sql(),
        "op12_presence_mask_search": lexical_search.op12_sql(),
    }
