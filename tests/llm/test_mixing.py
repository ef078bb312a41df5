import pytest
from pyspark.sql import functions as F

from cyclelake.llm.mixing import mix, taken_words


def words(n):
    return " ".join(["w"] * n)


def targets_by_resharing(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets as the rule tells them: shares by weight, capped, the excess reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += give[s]
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_taken(spark, documents):
    rows, n = [], 0
    for source, count in (("b", 300), ("a", 40), (None, 60), ("Z", 90), ("é", 5)):
        for i in range(count):
            rows.append((n, words(1 + (n * 7) % 23), source))
            n += 1
    out = taken_words(documents(rows)).collect()
    assert len(out) == n
    source = {r[0]: r[2] for r in rows}
    sizes, taken, target = {}, {}, {}
    for r in out:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    expected = targets_by_resharing(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 12
    assert all(r.source_size == sizes[source[r.doc_id]] for r in out)
    assert sorted(map(tuple, out)) == sorted(map(tuple, taken_words(documents(rows)).collect()))


def test_one_source_is_full(spark, documents):
    out = taken_words(documents([(i, words(10), "only") for i in range(40)])).collect()
    assert sum(r.taken for r in out) == 600 and out[0].target == 600.0


def test_odd_rows(spark, documents):
    df = documents([(1, None, "a"), (2, "", "a"), (None, "x y", None), (4, " \t\n", "b"), (4, " \t\n", "b"),
                    (5, "a b c\x0bd", "b")]).withColumn("size", F.lit("clash")).withColumn("_hash", F.lit(1))
    out = sorted(map(tuple, taken_words(df).select("doc_id", "size").collect()), key=str)
    assert out == sorted([(1, 0), (2, 0), (None, 2), (4, 0), (4, 0), (5, 3)], key=str)
    assert mix(df).columns == df.columns
    empty = taken_words(documents([(1, None, "a"), (2, "", None)])).collect()
    assert {(r.target, r.taken) for r in empty} == {(0.0, 0)}
    assert taken_words(documents([])).count() == 0 and mix(documents([])).count() == 0


def test_mix_repeats_rows(spark, documents):
    df = documents([(i, words(1 + i % 5), "ab"[i % 2]) for i in range(200)])
    copies = {r.doc_id: r.copies for r in taken_words(df).collect()}
    got = {r.doc_id: r["count"] for r in mix(df).groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}
