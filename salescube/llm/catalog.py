"""Registered queries of this package with their SQL."""

from salescube.llm import (
    decontamination, hard_negatives, language_id, line_dedup, near_dedup, ngram_lm, pii, piece_codec, prefix_trie, quality, secret_scan,
    substring_dedup, toxicity,
)
from salescube.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_lm_scoring": ngram_lm.op1_lm_scoring,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_language_id": language_id.op3_language_id,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_sentencepiece": piece_codec.op7_sentencepiece,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_pii": pii.op10_pii,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
