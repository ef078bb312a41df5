"""Registered queries of the training-data operators, and their reference SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from cyclelake.llm import queries as q
from cyclelake.llm import sql

QUERIES = {
    "op1_vector_dedup": (q.vector_dedup, sql.VECTOR_DEDUP),
    "op2_source_mix": (q.source_mix, sql.MIXING),
    "op3_token_counts": (q.token_counts, None),
    "op4_license_scan": (q.license_scan, None),
    "op5_exact_top_k": (q.exact_top_k, sql.TOP_K),
    "op6_quality": (q.quality, None),
    "op7_language_model": (q.language_model, None),
    "op8_ngram_join": (q.ngram_join, sql.NGRAM_JOIN),
    "op9_toxicity": (q.toxicity, None),
    "op10_packing": (q.packing, None),
    "op11_centroid_clusters": (q.centroid_clusters, sql.CLUSTERS),
    "op12_suffix_dedup": (q.suffix_dedup, sql.REPEATS),
    "op13_conversation_trie": (q.conversation_trie, sql.PREFIX_TRIE),
    "pipeline": (q.pipeline, corpus_pipeline.ORACLE_SQL),
}


def queries() -> dict:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict:
    return {name: text for name, (_, text) in QUERIES.items() if text is not None}
