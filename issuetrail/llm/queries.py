"""The queries of this package, and SQL where it can express one."""

from __future__ import annotations

from issuetrail.llm import (
    chat_format,
    decontamination,
    fingerprints,
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    personal_data,
    prefix_trie,
    ranked_search,
    toxicity,
    url_filter,
    vector_search,
)

QUERIES = {
    "op1_fingerprints": fingerprints.query,
    "op2_toxicity": toxicity.query,
    "op3_language_model": language_model.query,
    "op4_near_dedup": near_dedup.query,
    "op5_url_filter": url_filter.query,
    "op6_chat_format": chat_format.query,
    "op7_personal_data": personal_data.query,
    "op8_mixing": mixing.query,
    "op9_decontamination": decontamination.query,
    "op10_line_dedup": line_dedup.query,
    "op11_ranked_search": ranked_search.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_vector_search": vector_search.query,
}

ORACLES = {
    "op5_url_filter": url_filter.SQL,
    "op6_chat_format": chat_format.SQL,
    "op8_mixing": mixing.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_ranked_search": ranked_search.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_vector_search": vector_search.SQL,
}
