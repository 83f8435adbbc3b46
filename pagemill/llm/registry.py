"""Queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embedding_dedup, language_id, minhash_dedup, mixing, personal_data, sentence_pieces, sharding, token_counts, topk, toxicity, url_filter, valid_time, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cover_tree_dedup": embedding_dedup.op1_cover_tree_dedup,
    "op2_best_fit_shards": sharding.op2_best_fit_shards,
    "op3_systematic_mix": mixing.op3_systematic_mix,
    "op4_hyperdimensional_language": language_id.op4_hyperdimensional_language,
    "op5_block_top_k": topk.op5_block_top_k,
    "op6_contextual_pii": personal_data.op6_contextual_pii,
    "op7_longest_match_counts": token_counts.op7_longest_match_counts,
    "op8_sentence_pieces": sentence_pieces.op8_sentence_pieces,
    "op9_order_minhash": minhash_dedup.op9_order_minhash,
    "op10_url_rules": url_filter.op10_url_rules,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_valid_time_enrichment": valid_time.op12_valid_time_enrichment,
    "op13_annular_codes": vector_codes.op13_annular_codes,
}

SQL: dict[str, str] = {
    "op1_cover_tree_dedup": embedding_dedup.OP1_SQL,
    "op3_systematic_mix": mixing.OP3_SQL,
    "op5_block_top_k": topk.OP5_SQL,
    "op12_valid_time_enrichment": valid_time.OP12_SQL,
    "op13_annular_codes": vector_codes.OP13_SQL,
}
