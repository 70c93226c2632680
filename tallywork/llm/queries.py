"""The queries of this package by name, with SQL where SQL can state them."""

from __future__ import annotations

from tallywork.llm import (
    balls,
    bpe,
    dialogue,
    grouping,
    licences,
    minhash,
    mixing,
    neighbours,
    packing,
    pivots,
    quality,
    toxicity,
    urls,
)

QUERIES = {
    "op1_minhash_near_dedup": minhash.op1_minhash_near_dedup,
    "op2_mixture": mixing.op2_mixture,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality": quality.op4_quality,
    "op5_url_filter": urls.op5_url_filter,
    "op6_licences": licences.op6_licences,
    "op7_bpe_round_trip": bpe.op7_bpe_round_trip,
    "op8_nearest_neighbours": neighbours.op8_nearest_neighbours,
    "op9_vector_near_dedup": pivots.op9_vector_near_dedup,
    "op10_packed_rows": packing.op10_packed_rows,
    "op11_conversation_repair": dialogue.op11_conversation_repair,
    "op12_best_fit_packing": grouping.op12_best_fit_packing,
    "op13_ranked_search": balls.op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op2_mixture": mixing.OP2_SQL,
    "op5_url_filter": urls.OP5_SQL,
    "op6_licences": licences.OP6_SQL,
    "op11_conversation_repair": dialogue.OP11_SQL,
    "op13_ranked_search": balls.OP13_SQL,
}
