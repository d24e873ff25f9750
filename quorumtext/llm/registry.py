"""Queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from quorumtext.llm import convtrie, decontam, filteraudit, linededup, media, multiindex, pii, quality, simhash, spiece, substring, toxicity, urlfilter

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_quality": quality.op3_quality,
    "op4_sentencepiece": spiece.op4_sentencepiece,
    "op5_media": media.op5_media,
    "op6_decontamination": decontam.op6_decontamination,
    "op7_pii": pii.op7_pii,
    "op8_line_dedup": linededup.op8_line_dedup,
    "op9_url_filter": urlfilter.op9_url_filter,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_nearest": multiindex.op11_nearest,
    "op12_filter_audit": filteraudit.op12_filter_audit,
    "op13_conversation_trie": convtrie.op13_conversation_trie,
}

ORACLE_SQL = {
    "op6_decontamination": decontam.ORACLE,
    "op8_line_dedup": linededup.ORACLE,
    "op9_url_filter": urlfilter.ORACLE,
    "op12_filter_audit": filteraudit.ORACLE,
    "op13_conversation_trie": convtrie.ORACLE,
}
