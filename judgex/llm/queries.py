"""The queries of this subpackage and, where SQL can express them, the same as DuckDB SQL."""

from __future__ import annotations

from judgex.llm import classifier, clustering, decontamination, html, jaccard, mixing, quality, resampling, spans, suffixes, tokens, urls, warc

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_warc": warc.op2_warc,
    "op3_quality_classifier": classifier.op3_quality_classifier,
    "op4_url_filter": urls.op4_url_filter,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_html_text": html.op7_html_text,
    "op8_decontaminate": decontamination.op8_decontaminate,
    "op9_sentence_spans": spans.op9_sentence_spans,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_token_ids": tokens.op11_token_ids,
    "op12_importance_resampling": resampling.op12_importance_resampling,
    "op13_centroid_clusters": clustering.op13_centroid_clusters,
}

#: The others take hashes, models or vocabularies that SQL lacks; tests hold them against brute force.
ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op2_warc": warc.ORACLE,
    "op8_decontaminate": decontamination.ORACLE,
    "op13_centroid_clusters": clustering.ORACLE,
}
