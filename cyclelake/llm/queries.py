"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from cyclelake.llm.conversation_trie import prefix_trie
from cyclelake.llm.laesa import cluster_report
from cyclelake.llm.language_model import pseudo_likelihood
from cyclelake.llm.licenses import scan_licenses
from cyclelake.llm.mixing import taken_words
from cyclelake.llm.ngram_join import similar_classes
from cyclelake.llm.packing import pack
from cyclelake.llm.quality import quality_scores
from cyclelake.llm.suffix_dedup import repeats_report
from cyclelake.llm.token_count import count_tokens
from cyclelake.llm.topk import top_k
from cyclelake.llm.toxicity import toxicity_scores
from cyclelake.llm.vector_dedup import near_vectors


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vector_dedup(spark, sf_dir):
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def source_mix(spark, sf_dir):
    return taken_words(_table(spark, sf_dir, "documents"))


def token_counts(spark, sf_dir):
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def license_scan(spark, sf_dir):
    return scan_licenses(_table(spark, sf_dir, "documents"))


def exact_top_k(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"))


def quality(spark, sf_dir):
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def language_model(spark, sf_dir):
    return pseudo_likelihood(_table(spark, sf_dir, "documents"))


def ngram_join(spark, sf_dir):
    return similar_classes(_table(spark, sf_dir, "documents"))


def toxicity(spark, sf_dir):
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def packing(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def centroid_clusters(spark, sf_dir):
    return cluster_report(_table(spark, sf_dir, "embeddings"))


def conversation_trie(spark, sf_dir):
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def suffix_dedup(spark, sf_dir):
    return repeats_report(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
