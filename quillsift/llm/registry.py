"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from quillsift.llm import chat, jaccard, lines, merkle, mixing, packing, quality, suffix, tokens, toxicity

QUERIES = {
    "op1_suffix_dedup": suffix.op1_suffix_dedup,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_token_output": tokens.op3_token_output,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_chat_format": chat.op6_chat_format,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_merkle_fingerprints": merkle.op8_merkle_fingerprints,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_mix_sources": mixing.op10_mix_sources,
}

#: The others rest on models, tokenizers, hashes or encodings that SQL lacks: tests/llm holds them against plain Python.
ORACLES = {"op2_quality_rules": quality.OP2_SQL, "op4_ngram_jaccard": jaccard.OP4_SQL, "op9_line_dedup": lines.OP9_SQL}
