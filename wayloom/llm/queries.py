"""The queries of this package by name, and SQL where SQL can say the same."""

from wayloom.llm import decontaminate, exact, jaccard, lang_id, licenses, link_trust, lm_score, mixing, pii, prefix_terms, runs, suffix_dedup, topk

QUERIES = {
    "op1_skip_chain": pii.op1_skip_chain,
    "op2_cgk_windows": decontaminate.op2_cgk_windows,
    "op3_link_trust": link_trust.op3_link_trust,
    "op4_suffix_runs": suffix_dedup.op4_suffix_runs,
    "op5_attention_score": lm_score.op5_attention_score,
    "op6_shingle_join": jaccard.op6_shingle_join,
    "op7_norm_buckets": topk.op7_norm_buckets,
    "op8_byte_cnn": lang_id.op8_byte_cnn,
    "op9_patience_licenses": licenses.op9_patience_licenses,
    "op10_source_schedule": mixing.op10_source_schedule,
    "op11_repair_runs": runs.op11_repair_runs,
    "op12_prefix_iceberg": prefix_terms.op12_prefix_iceberg,
    "op13_perfect_hash": exact.op13_perfect_hash,
}
ORACLES = {
    "op3_link_trust": link_trust.OP3_SQL,
    "op6_shingle_join": jaccard.OP6_SQL,
    "op7_norm_buckets": topk.OP7_SQL,
    "op10_source_schedule": mixing.OP10_SQL,
    "op12_prefix_iceberg": prefix_terms.OP12_SQL,
    "op13_perfect_hash": exact.OP13_SQL,
}
