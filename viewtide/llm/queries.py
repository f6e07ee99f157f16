"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from viewtide.llm import (
    chat,
    decontamination,
    hard_negatives,
    language,
    licenses,
    mixing,
    near_duplicates,
    neighbours,
    prefix_trie,
    repeats,
    simhash,
    toxicity,
    wavelet,
)

QUERIES = {
    "op1_mix_sources": mixing.query,
    "op2_repeats": repeats.query,
    "op3_token_files": wavelet.query,
    "op4_chat": chat.query,
    "op5_toxicity": toxicity.query,
    "op6_neighbours": neighbours.query,
    "op7_near_duplicates": near_duplicates.query,
    "op8_language": language.query,
    "op9_decontamination": decontamination.query,
    "op10_licenses": licenses.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_simhash": simhash.query,
}

ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op2_repeats": repeats.ORACLE,
    "op4_chat": chat.ORACLE,
    "op7_near_duplicates": near_duplicates.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
