import random

from pyspark.sql import functions as F

from cyclelake.llm import ngram_join
from cyclelake.llm.components import components
from cyclelake.llm.ngram_join import keep_one, similar_classes


def shingles(text, k=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, threshold=80):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= threshold * len(s | t):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def corpus(seed, families=14, long=120):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ab") + str(rnd.randint(0, 4000))
    passage = [word() for _ in range(30)]
    rows, n = [], 0
    for _ in range(families):
        base = [word() for _ in range(rnd.randint(3, long))]
        for _ in range(rnd.choice([1, 2, 3, 9, 25])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.3:
                at = rnd.randrange(len(copy))
                copy[at:at] = passage
            rows.append((n, " ".join(copy)))
            n += 1
    rnd.shuffle(rows)
    return rows


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_equals_brute_force(spark, documents):
    rows = corpus(1)
    assert got(similar_classes(documents(rows).repartition(3))) == brute(rows)


def test_small_slices_and_no_stars(spark, documents, monkeypatch):
    """Screening over many slices, and every pair found by the prefixes alone."""
    monkeypatch.setattr(ngram_join, "SLICE_DOCS", 4)
    monkeypatch.setattr(ngram_join, "STAR_KEYS", 1)
    rows = corpus(3, families=12, long=60)
    assert got(similar_classes(documents(rows))) == brute(rows)


def test_many_near_copies(spark, documents):
    """Outliers of a large group of near copies, which link with some of its members and not with its centre."""
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(100)]
    rows = []
    for n in range(150):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(10) * 10] = f"x{rnd.randint(0, 12)}"
        rows.append((n, " ".join(copy)))
    assert got(similar_classes(documents(rows))) == brute(rows)


def test_other_thresholds(spark, documents):
    rows = corpus(7, families=8, long=50)
    for threshold in (40, 90):
        assert got(similar_classes(documents(rows), threshold=threshold)) == brute(rows, threshold)


def test_odd_rows(spark, documents):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(9, "One two"), (4, "one TWO"), (5, "one two three"), (None, "one two"), (6, None), (7, ""), (8, " \n\t"),
            (3, "É two"), (2, "é two"), (1, "a\x85b c d e"), (10, "a\x85b c d e"), (11, long), (12, long + " tail"),
            (20, "again and again and again and again"), (20, "again and again and again and again")]
    df = documents(rows).withColumn("n", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("component_id", F.lit(1))
    assert got(similar_classes(df)) == brute(rows)
    kept = sorted((r.doc_id or 0) for r in keep_one(df).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 6, 7, 8, 11, 20]
    assert keep_one(df).columns == df.columns
    assert similar_classes(documents([])).count() == 0 and keep_one(documents([])).count() == 0


def test_components(spark):
    path = [(i, i + 1) for i in range(40, 60)] + [(7, 7), (None, 3), (3, 1), (1, 3), (100, 90), (90, 95), (95, 60)]
    out = dict(map(tuple, components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert out == {**{i: 40 for i in range(40, 61)}, 100: 40, 90: 40, 95: 40, 1: 1, 3: 1}
