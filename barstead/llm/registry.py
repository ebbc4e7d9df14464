"""Queries of the numbered operators and the SQL that checks them."""

from __future__ import annotations

from . import bpe, chat_format, exact_dedup, filter_audit, hard_negatives, language_id, license_scan, mixing, near_dedup, packing, private_data, quality_rules, substring_dedup

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_private_data": private_data.op3_private_data,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_language_id": language_id.op10_language_id,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_bpe_round_trip": bpe.op12_bpe_round_trip,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op2_near_dedup": near_dedup.OP2_SQL,
    "op4_source_mixing": mixing.OP4_SQL,
    "op5_substring_dedup": substring_dedup.OP5_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op9_chat_format": chat_format.OP9_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
