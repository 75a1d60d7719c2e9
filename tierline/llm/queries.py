"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from tierline.llm import (
    bpe,
    main_text,
    mixing,
    neighbours,
    ngram_join,
    packing,
    periodic_runs,
    prefix_trie,
    quality_rules,
    repeated_bytes,
    repeated_windows,
    token_counts,
    warc,
)

QUERIES = {
    "op5_signature_tree_join": ngram_join.query,
    "op6_suffix_dedup": repeated_bytes.query,
    "op8_cover_anchor_dedup": repeated_windows.query,
    "op3_stable_projection_search": neighbours.query,
    "op2_main_text": main_text.query,
    "op4_warc_salvage": warc.query,
    "op9_pack_ids": packing.query,
    "op1_bpe": bpe.query,
    "op7_mix_sources": mixing.query,
    "op10_quality_rules": quality_rules.query,
    "op11_token_counts": token_counts.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_periodic_runs": periodic_runs.query,
}
ORACLE = {
    "op8_cover_anchor_dedup": repeated_windows.ORACLE,
    "op4_warc_salvage": warc.ORACLE,
    "op7_mix_sources": mixing.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
