"""Queries of the text operators by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from haulwatch.llm import (
    exact_dedup, license_scan, line_dedup, merkle, mixing, near_dedup, packing, quality_crf, quality_rules, rank_bpe,
    secret_scan, spelling, substring_dedup,
)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_quality_crf": quality_crf.op5_quality_crf,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_minmax_near_dedup": near_dedup.op8_minmax_near_dedup,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_rank_bpe": rank_bpe.op11_rank_bpe,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
ORACLES = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op10_license_scan": license_scan.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
