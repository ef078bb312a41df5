"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next stage's documents.
Rejected documents, and all but one of each class of near copies, are gone after their stage; the mix repeats documents.
Null texts are empty documents in every stage, rows without an id pass the near-duplicate stage, repeated rows are near copies of
each other, ties are decided by the smaller id; an empty table gives an empty result; other columns are handed on until packing.
"""

from __future__ import annotations

import public_tokenizers

from cyclelake.llm.common import staged
from cyclelake.llm.mixing import mix
from cyclelake.llm.ngram_join import keep_one
from cyclelake.llm.packing import pack
from cyclelake.llm.quality import accepted
from cyclelake.llm.toxicity import clean_documents


def _labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark, docs, sf_dir):
    return accepted(docs, _labels(spark, sf_dir))


def toxicity(spark, docs, sf_dir):
    return clean_documents(docs, _labels(spark, sf_dir))


def near_duplicates(spark, docs, sf_dir):
    return keep_one(docs)


def mixing(spark, docs, sf_dir):
    return mix(docs)


def packing(spark, docs, sf_dir):
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mixing", mixing),
          ("packing", packing)]

#: Two stages are learned classifiers, which SQL cannot express; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
