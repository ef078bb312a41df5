import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cyclelake.llm import catalog
from cyclelake.llm.packing import ChunkTokenizer
from cyclelake.llm.quality import quality_scores
from cyclelake.llm.toxicity import toxicity_scores
from oracle import compare, connect

from .test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in catalog.queries()} - {"pipeline"}


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, name):
    ok, message = compare(spark, connect(SF), name, catalog.queries()[name], catalog.oracle_sql()[name], SF)
    assert ok, message


def test_run_against_plain_python(spark):
    """The stages' decisions recomputed outside Spark from the classifiers' scores."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality_scores(docs, labels).collect() if r.predicted == 1}
    kept = docs.filter(docs.doc_id.isin(sorted(good)))
    calm = {r.doc_id for r in toxicity_scores(kept, labels).collect() if r.predicted == 0}
    single = {i for i, _, c in brute([(i, texts[i]) for i in sorted(calm)]) if i == c}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= single and len(single) < len(texts)
    ids = dict(zip(sorted(single), ChunkTokenizer(public_tokenizers.path("word_bpe_49k.json")).encode([texts[i] for i in sorted(single)])))
    pieces = {}
    for r in out:
        assert r.doc_tokens == len(ids[r.doc_id]) + 1
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
    assert all(pieces[i] % (len(ids[i]) + 1) == 0 and pieces[i] // (len(ids[i]) + 1) <= 2 for i in pieces)
    words = sum(len(texts[i].split()) for i in single)
    taken = sum(len(texts[i].split()) * pieces.get(i, 0) // (len(ids[i]) + 1) for i in single)
    assert abs(taken - 1.5 * words) <= 0.15 * words


def test_stages_keep_columns(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
