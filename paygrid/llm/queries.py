"""Registered queries of the subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from paygrid.llm import alignment, bpe, content, decontaminate, fingerprints, jaccard_join, negatives, pii, quality, sharding, substring_dedup, suffix_dedup, toxicity

QUERIES = {f.__name__: f for f in (
    fingerprints.op1_merkle_fingerprints,
    decontaminate.op2_decontamination,
    substring_dedup.op3_substring_dedup,
    suffix_dedup.op4_suffix_array_dedup,
    toxicity.op5_toxicity,
    quality.op6_quality_classifier,
    sharding.op7_stratified_shards,
    jaccard_join.op8_jaccard_join,
    bpe.op9_byte_bpe,
    pii.op10_pii,
    content.op11_main_text,
    negatives.op12_hard_negatives,
    alignment.op13_token_alignment,
)}

ORACLE = {
    "op2_decontamination": decontaminate.ORACLE,
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op4_suffix_array_dedup": suffix_dedup.ORACLE,
    "op8_jaccard_join": jaccard_join.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
}
