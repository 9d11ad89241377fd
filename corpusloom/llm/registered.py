"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import best_fit_packing, conversation_repair, decontamination, extendible_sharding, license_scan, line_dedup, quality_classifier, quality_rules, simhash_neardup, spelling_variants, substring_dedup, token_counts, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_best_fit_packing": best_fit_packing.op4_best_fit_packing,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_quality_classifier": quality_classifier.op8_quality_classifier,
    "op9_extendible_sharding": extendible_sharding.op9_extendible_sharding,
    "op10_simhash_neardup": simhash_neardup.op10_simhash_neardup,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_spelling_variants": spelling_variants.op12_spelling_variants,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op6_url_filter": url_filter.OP6_SQL,
    "op9_extendible_sharding": extendible_sharding.OP9_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
