"""The queries of this folder and the SQL they must agree with."""

from __future__ import annotations

from pricetide.llm import (bpe, decontamination, html_extraction, interpolation, license_scans, paragraph_dedup, prefix_trie,
                           quality_rules, quote_linking, simhash, source_divergence, token_files, url_filters)

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_simhash_near_dedup": simhash.op2,
    "op3_quotation_linking": quote_linking.op3,
    "op4_arrow_token_files": token_files.op4,
    "op5_paragraph_dedup": paragraph_dedup.op5,
    "op6_deleted_interpolation": interpolation.op6,
    "op7_html_extraction": html_extraction.op7,
    "op8_benchmark_decontamination": decontamination.op8,
    "op9_byte_level_bpe": bpe.op9,
    "op10_url_filters": url_filters.op10,
    "op11_license_scans": license_scans.op11,
    "op12_source_divergence": source_divergence.op12,
    "op13_prefix_trie": prefix_trie.op13,
}
ORACLES = {
    "op1_quality_rules": quality_rules.quality_sql(),
    "op3_quotation_linking": quote_linking.quote_sql(),
    "op10_url_filters": url_filters.url_sql(),
    "op11_license_scans": license_scans.license_sql(),
    "op12_source_divergence": source_divergence.divergence_sql(),
    "op13_prefix_trie": prefix_trie.trie_sql(),
}
