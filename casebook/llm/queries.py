"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from casebook.llm import chat, digests, factors, langid, mixing, phrases, pieces, quality, repeats, resampling, simhash, token_files, treaps

QUERIES = {
    "op1_neighbour_quality": quality.op1,
    "op2_reply_trees": chat.op2,
    "op3_pareto_mix": mixing.op3,
    "op4_phrase_fingerprints": phrases.op4,
    "op5_sentencepiece": pieces.op5,
    "op6_token_files": token_files.op6,
    "op7_suffix_repeats": repeats.op7,
    "op8_simhash_ring": simhash.op8,
    "op9_gated_langid": langid.op9,
    "op10_digest_index": digests.op10,
    "op11_treap_search": treaps.op11,
    "op12_gumbel_resampling": resampling.op12,
    "op13_previous_factors": factors.op13,
}
ORACLES = {
    "op2_reply_trees": chat.OP2_SQL,
    "op3_pareto_mix": mixing.OP3_SQL,
    "op7_suffix_repeats": repeats.OP7_SQL,
    "op10_digest_index": digests.OP10_SQL,
    "op11_treap_search": treaps.OP11_SQL,
    "op12_gumbel_resampling": resampling.OP12_SQL,
    "op13_previous_factors": factors.OP13_SQL,
}
