import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cyclelake.llm import token_count
from cyclelake.llm.token_count import Merger, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "a", " ", "\n\n  x", "aaaaaaaaaaaaaaaaa" * 40, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "a\x1cb \x1c\x1d x",
    "日本語のテキスト 漢字", "🙂🙂🙃 é́ é", "   x　y", "it's we'll I'd '' '", "٣٤٥ ²³ Ⅷ", "a\r\n\r\n b\t\tc  d   ",
    "!!!!!!!!!!!???", "ß" * 999, " lead", "trail ", "a  b", "\x85 x \x85",
]


def expected(texts):
    encoded = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def noise(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab \n'sé1日 !<|>") for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_counts_equal_the_library():
    texts = ODD + noise(2000)
    assert Merger(PATH).counts(texts) == expected(texts)


def test_small_slices_and_a_full_table_change_nothing(monkeypatch):
    for name, value in (("SLICE_CHARS", 20), ("SLICE_TOKENS", 3), ("KNOWN", 50)):
        monkeypatch.setattr(token_count, name, value)
    texts = ODD + noise(500, seed=2)
    assert Merger(PATH).counts(texts) == expected(texts)


def test_rows(spark, documents):
    long = "word " * 3000
    df = documents([(1, "two words"), (None, None), (3, ""), (4, long), (4, long)]).withColumn("n_tokens", F.lit("clash"))
    rows = sorted(map(tuple, count_tokens(df, PATH).collect()), key=str)
    count = expected([long])[0]
    assert rows == sorted(
        [(1, 9, 2, False), (None, 0, 0, False), (3, 0, 0, False), (4, 15000, count, True), (4, 15000, count, True)], key=str)
    assert count_tokens(documents([]), PATH).count() == 0
