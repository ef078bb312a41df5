import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cyclelake.llm import packing
from cyclelake.llm.packing import ChunkTokenizer, Packer, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "Hello, World! it's  we'll", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> c<|", "ΑΣ ΟΔΟΣ Σ", "é é İ ﬁ",
    "日本語 テキスト", "a\x1cb\x85c　d", "x" * 3000, "1234 ٣٤٥", "🙂🙃", "́ a ́b", "A\r\nB\x0bC\x0cD",
]


def library_ids(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def noise(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abAB \n'séßÿ÷à\u0301É1日Σ !<|>") for _ in range(rnd.randint(1, 50))) for _ in range(n)]


def test_ids_equal_the_library(monkeypatch):
    texts = ODD + noise(1500)
    assert [x.tolist() for x in ChunkTokenizer(PATH).encode(texts)] == library_ids(texts)
    monkeypatch.setattr(packing, "KNOWN", 40)
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)
    assert [x.tolist() for x in ChunkTokenizer(PATH).encode(texts)] == library_ids(texts)


def test_every_single_byte_character_and_noise_of_them():
    rnd = random.Random(5)
    texts = [chr(c) for c in range(256)] + [f"ab{chr(c)}cd {chr(c)}" for c in range(256)]
    texts += ["".join(chr(rnd.randrange(256)) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    assert [x.tolist() for x in ChunkTokenizer(PATH).encode(texts)] == library_ids(texts)


def check(rows, documents, window=4096):
    """rows: (doc_id, start, length, crc, doc_tokens, sequence_id, offset, context, group); documents: id -> ids."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r[0], []).append(r)
        sequences.setdefault(r[5], []).append(r)
    assert set(pieces) == set(documents)
    for doc, ids in documents.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r[1]):
            assert r[1] == at and r[2] > 0 and r[4] == len(ids)
            assert r[3] == zlib.crc32(np.array(ids[at:at + r[2]], "<u4").tobytes())
            at += r[2]
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        assert at <= window and own[0][7] == at
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0


@pytest.mark.parametrize("waiting", [0, 3, 200])
def test_pieces_cover_documents_without_padding(waiting):
    rnd = np.random.default_rng(waiting)
    documents = {i: rnd.integers(0, 49_000, int(n)).tolist() for i, n in enumerate(
        [1, 1, 4096, 8192, 4097, 20_000, 512, 511] + list(rnd.integers(1, 3000, 150)))}
    packer = Packer(3, waiting=waiting)
    for i, ids in documents.items():
        packer.add(i, np.array(ids, np.int32))
    packer.finish()
    check(packer.rows, documents)


def test_step_groups_are_short_once_per_context(spark, documents):
    rnd = random.Random(3)
    df = documents([(i, " ".join(["word"] * rnd.choice([90, 300, 700, 1500, 9000]))) for i in range(150)]).repartition(6)
    pieces = pack(df, PATH)
    assert pieces.select(F.shiftright("sequence_id", 40)).distinct().count() > 3
    groups = pieces.groupBy("context", "step_group").agg(F.sum("length").alias("tokens")).collect()
    short = {}
    for g in groups:
        assert g.tokens <= max(packing.STEP_TOKENS, g.context)
        short.setdefault(g.context, []).append(g.tokens < packing.STEP_TOKENS)
    assert all(sum(s) <= 1 for s in short.values()) and sum(len(s) for s in short.values()) > 10


def test_pack(spark, documents):
    texts = noise(300, seed=4) + ["many words here " * 4000, "", "tie", "tie"]
    df = documents(list(enumerate(texts)) + [(9000, None)]).withColumn("start", F.lit("clash")).repartition(3)
    rows = [tuple(r) for r in pack(df, PATH).collect()]
    ids = {i: x + [2] for i, x in enumerate(library_ids(texts))} | {9000: [2]}
    check(rows, ids)
    same = documents([(7, "tie tie"), (7, "tie tie"), (None, "no id")])
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in pack(same, PATH).collect() if r.start == 0) == [(0, 3), (7, 3), (7, 3)]
    assert pack(documents([]), PATH).count() == 0


def test_words_are_remembered_in_bounded_arrays(monkeypatch):
    """A table of words without bound, a tuple of numbers for each, took a worker's memory."""
    texts = [" ".join(f"{a}{b}{k}" for a in "abcdefgh" for b in ("xy", "é", "zü")) for k in range(300)]
    monkeypatch.setattr(packing, "KNOWN_WORDS", 30)
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)
    tokenizer, most = ChunkTokenizer(PATH), 0
    for ids, wanted in zip(tokenizer.encode(texts + ODD), library_ids(texts + ODD)):
        assert ids.tolist() == wanted
        most = max(most, len(tokenizer.words.number))
    assert 0 < most <= 30 + 200 and all(type(n) is int for n in tokenizer.words.number.values())


def test_no_worker_keeps_tables_after_a_partition(spark, documents):
    """Workers take the tasks of a stage in turn; what each keeps adds up."""
    def left(batches):
        gc.collect()
        for batch in batches:
            kept = sum(type(o).__name__ in ("ChunkTokenizer", "Sequences") for o in gc.get_objects())
            kept += sum(len(v) for n, v in vars(packing).items() if n.isupper() and isinstance(v, dict))
            yield batch.assign(kept=kept)[["kept"]]

    df = documents([(i, f"word{i} some text") for i in range(40)]).coalesce(1)
    assert pack(df, PATH).select("doc_id").distinct().count() == 40
    assert {r.kept for r in df.mapInPandas(left, "kept bigint").collect()} == {0}
