"""The queries of the operators, and their SQL."""

from __future__ import annotations

from . import alignment, decontamination, html_text, ngram_join, packing, quality, sharding, suffix_dedup, token_counts, urls, vector_links, warc, whitening

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_url_filters": urls.op3_url_filters,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_html_text": html_text.op6_html_text,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_warc": warc.op8_warc,
    "op9_packing": packing.op9_packing,
    "op10_sharding": sharding.op10_sharding,
    "op11_vector_links": vector_links.op11_vector_links,
    "op12_whitening": whitening.op12_whitening,
    "op13_alignment": alignment.op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": decontamination.ORACLE,
    "op3_url_filters": urls.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_warc": warc.ORACLE,
}
