"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from loam.llm import chat_views, fingerprints, line_dedup, ngram_join, quality_classifier, quality_rules, sentence_pieces, source_mix, suffix_tree_lm, url_filter

QUERIES = {
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_suffix_tree_lm": suffix_tree_lm.op4_suffix_tree_lm,
    "op5_url_filter": url_filter.op5_url_filter,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op6_chat_views": chat_views.op6_chat_views,
    "op7_sentence_pieces": sentence_pieces.op7_sentence_pieces,
    "op8_source_mix": source_mix.op8_source_mix,
}
ORACLE_SQL = {
    "op5_url_filter": url_filter.OP5_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op6_chat_views": chat_views.OP6_SQL,
    "op8_source_mix": source_mix.OP8_SQL,
}
