"""The queries of this package by name, and their SQL."""

from __future__ import annotations

from scholmill.llm import query_decontamination, query_dedup, query_models, query_nearest, query_packing, query_pii, query_variants


def queries() -> dict:
    return {
        "op1_permutation_index": query_nearest.op1_permutation_index,
        "op2_quality": query_models.op2_quality,
        "op3_near_dedup": query_dedup.op3_near_dedup,
        "op4_decontamination": query_decontamination.op4_decontamination,
        "op5_substring_dedup": query_dedup.op5_substring_dedup,
        "op6_best_fit_packing": query_packing.op6_best_fit_packing,
        "op7_suffix_dedup": query_dedup.op7_suffix_dedup,
        "op8_line_dedup": query_dedup.op8_line_dedup,
        "op9_personal_data": query_pii.op9_personal_data,
        "op10_language_id": query_models.op10_language_id,
        "op11_conversation_trie": query_variants.op11_conversation_trie,
        "op12_license_scan": query_variants.op12_license_scan,
        "op13_spelling_variants": query_variants.op13_spelling_variants,
    }


def oracle_sql() -> dict:
    return {"op5_substring_dedup": query_dedup.OP5_SQL, "op7_suffix_dedup": query_dedup.OP7_SQL, "op8_line_dedup": query_dedup.OP8_SQL, "op12_license_scan": query_variants.OP12_SQL}
