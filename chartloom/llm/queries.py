"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from chartloom.llm import bpe_table, language_id, license_scan, media, near_dup, packing, quality_classifier, quality_rules, secret_scan, token_files

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_quality_rules": quality_rules.query,
    "op3_token_files": token_files.query,
    "op4_packing": packing.query,
    "op5_near_dup": near_dup.query,
    "op6_secret_scan": secret_scan.query,
    "op7_language_id": language_id.query,
    "op8_quality_classifier": quality_classifier.query,
    "op9_bpe_table": bpe_table.query,
    "op10_media_copies": media.query,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op2_quality_rules": quality_rules.oracle(),
}
