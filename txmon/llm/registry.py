"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from txmon.llm import (ann, chat_format, exact_dedup, filter_audit, html_extract, language_id, mixing, near_dedup, packing,
                       quality_rules, toxicity, url_filter, whitening)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_ann": ann.op5_ann,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_packing": packing.op7_packing,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_language_id": language_id.op9_language_id,
    "op10_html_extract": html_extract.op10_html_extract,
    "op11_whitening": whitening.op11_whitening,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLES = {
    "op2_chat_format": chat_format.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op12_quality_rules": quality_rules.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
