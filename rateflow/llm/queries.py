"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from rateflow.llm import (
    block_neighbours,
    exact_dedup,
    language,
    licenses,
    near_dedup,
    packing,
    secrets,
    sentence_pieces,
    sharding,
    spelling_variants,
    suffix_dedup,
    vector_codes,
    vector_search,
)

QUERIES = {
    "op1_pack": packing.q_pack,
    "op2_suffix_dedup": suffix_dedup.q_suffix_dedup,
    "op3_language": language.q_language,
    "op4_exact_dedup": exact_dedup.q_exact_dedup,
    "op5_sentence_pieces": sentence_pieces.q_sentence_pieces,
    "op6_secrets": secrets.q_secrets,
    "op7_near_dedup": near_dedup.q_near_dedup,
    "op8_licenses": licenses.q_licenses,
    "op9_shards": sharding.q_shards,
    "op10_top_k": vector_search.q_top_k,
    "op11_spelling_variants": spelling_variants.q_spelling_variants,
    "op12_vector_codes": vector_codes.q_vector_codes,
    "op13_block_neighbours": block_neighbours.q_block_neighbours,
}

ORACLE_SQL = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op7_near_dedup": near_dedup.SQL,
    "op10_top_k": vector_search.SQL,
    "op11_spelling_variants": spelling_variants.SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_block_neighbours": block_neighbours.SQL,
}
