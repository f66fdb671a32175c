"""Registered queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from . import (
    bpe, chat, fingerprints, jaccard, linededup, manifest, mixing, negatives, neighbours,
    sharding, substrings, templates, toxicity,
)

QUERIES = {
    "op1_shard_differencing": sharding.query,
    "op2_toxicity": toxicity.query,
    "op3_bpe_round_trip": bpe.query,
    "op4_mix_sources": mixing.query,
    "op5_shingle_jaccard": jaccard.query,
    "op6_chat_format": chat.query,
    "op7_prefix_forest": neighbours.query,
    "op8_repeated_passages": substrings.query,
    "op9_merkle_fingerprints": fingerprints.query,
    "op10_fuzzy_lines": linededup.query,
    "op11_merkle_manifest": manifest.query,
    "op12_page_templates": templates.query,
    "op13_hard_negatives": negatives.query,
}

ORACLES = {
    "op4_mix_sources": mixing.SQL,
    "op6_chat_format": chat.SQL,
    "op9_merkle_fingerprints": fingerprints.SQL,
    "op11_merkle_manifest": manifest.SQL,
    "op13_hard_negatives": negatives.SQL,
}
