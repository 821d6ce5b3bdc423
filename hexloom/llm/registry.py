"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from hexloom.llm import bands, chat, lm, mixing, near, pieces, quality, repeats, sketch, tokens

QUERIES = {
    "op1_hierarchical_mix": mixing.op1,
    "op2_suffix_repeats": repeats.op2,
    "op3_quality_discriminant": quality.op3,
    "op4_kneser_ney": lm.op4,
    "op5_scaled_sketch": sketch.op5,
    "op6_simple8b_ids": tokens.op6,
    "op7_lsh_forest": near.op7,
    "op8_reply_trees": chat.op8,
    "op9_merge_dropout": pieces.op9,
    "op10_compression_bands": bands.op10,
    # more of the operators' own interfaces, with SQL
    "chat_branches": chat.branches,
    "base_counts": bands.base_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op1_hierarchical_mix": mixing.oracle(),
    "op7_lsh_forest": near.ORACLE,
    "op8_reply_trees": chat.ORACLE,
    "chat_branches": chat.BRANCHES,
    "base_counts": bands.ORACLE,
}
