import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.llm.vector_dedup import Graph, _build, _search, find_hits, near_vectors

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cloud(n, dim=24, seed=1, hot=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 9):
        x[i] = x[rng.integers(n)] + 0.03 * rng.normal(size=dim)
    x[:hot] = x[0] + 0.1 * rng.normal(size=(hot, dim))
    return rng.permutation(x)


def test_search_recall():
    x = unit(cloud(3000, seed=3, hot=300))
    graph = Graph(x)
    hit, beam = find_hits(graph, x, 0.98)
    found = set(zip(*[a.tolist() for a in np.nonzero(hit)]))
    truth = set(zip(*[a.tolist() for a in np.nonzero(x @ x.T >= 0.98)]))
    assert found <= truth and len(found) >= 0.97 * len(truth) and beam * 8 < len(x)
    ids, sims = graph.search(x[:200], 48)
    best = (x[:200] @ x.T).argsort(1)[:, -5:]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids.tolist(), best.tolist())]) >= 0.9


def brute(rows, threshold=0.98):
    ok = [(n, i, np.array(v, float) / max(map(abs, v)), l) for n, (i, v, l) in enumerate(rows)
          if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {}, {i: i for i, _, _ in rows if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for n, i, v, l in ok:
        for m, j, w, k in ok:
            if n != m and l == k and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                links[n] = links.get(n, 0) + 1
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted(((i, links.get(n, 0), find(i) if i is not None else None, i is not None and find(i) == i)
                   for n, (i, _, _) in enumerate(rows)), key=str)


def test_equals_brute_force(spark):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(cloud(420, seed=5))]
    rows += [(1000 + k, rows[k % 4][1], rows[k % 4][2]) for k in range(40)]               # copies
    rows += [(900, None, 0), (901, [0.0] * 24, 0), (902, [None] * 24, 0), (903, [float("nan")] * 24, 0),
             (904, rows[3][1], None), (905, rows[3][1][:5], 0), (906, [2 * x for x in rows[0][1]], 0), (907, [], 0),
             (None, rows[0][1], 0), (908, [1e200] * 24, 1), (909, [1e200] * 24, 1), (909, [1e200] * 24, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash")).withColumn("rep", F.lit(1))
    for options in ({}, {"shard_rows": 60}):
        assert sorted(map(tuple, near_vectors(df, **options).collect()), key=str) == brute(rows)


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sparse_links_are_found_when_the_search_misses_them(monkeypatch):
    rng = np.random.default_rng(8)
    x = unit(rng.normal(size=(3000, 24)))
    x[1::300] = unit(x[0::300] + 0.01 * rng.normal(size=x[0::300].shape))
    truth = set(zip(*[a.tolist() for a in np.nonzero(x @ x.T >= 0.98)]))
    assert len(truth) == 3020
    search = Graph.search

    def forgetful(self, queries, beam, layer=0, expand=4):
        """Finds all nearest vectors but links."""
        ids, sims = search(self, queries, beam, layer, expand)
        lost = (sims >= 0.98) & (sims < 1 - 1e-9)
        return np.where(lost, -1, ids), np.where(lost, -np.inf, sims)

    graph = Graph(x)
    monkeypatch.setattr(Graph, "search", forgetful)
    hit, _ = find_hits(graph, x, 0.98)
    assert set(zip(*[a.tolist() for a in np.nonzero(hit)])) == truth


def test_dense_shard_takes_bounded_memory():
    """Thousands of vectors that all link with each other: the hits are one bit map, and no pair is kept."""
    rng = np.random.default_rng(2)
    values = rng.normal(size=32) + 0.005 * rng.normal(size=(4000, 32))
    group = pd.DataFrame({"rep": np.arange(4000), "vector": list(values), "label": 0, "shard": 0, "times": 1})
    row = _build(group).assign(shard_q=0)
    row = row.assign(**{f"{c}_q": row[c] for c in ("reps", "times", "vectors")})
    tracemalloc.start()
    found = _search(0.98)(row)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    links = found[found["links"] > 0]
    assert (links["links"] == 3999).all() and len(links) == 4000 and (found[found["links"] == 0]["other"] == 0).all()


def test_large_label_equals_brute_force(spark):
    x = cloud(2600, seed=9)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    out = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    links = (unit(x) @ unit(x).T >= 0.98).sum(1) - 1
    found = np.array([out[i] for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()


def test_a_failed_audit_leads_to_the_whole_shard(monkeypatch):
    """Wider beams cost several times the comparison with all vectors of a shard, and it misses nothing."""
    x = unit(cloud(3000, seed=6))
    graph, beams, search = Graph(x), set(), Graph.search

    def blind(self, queries, beam, layer=0, expand=4):
        beams.add(beam)
        ids, sims = search(self, queries, beam, layer, expand)
        return np.full_like(ids, -1), np.full_like(sims, -np.inf)

    monkeypatch.setattr(Graph, "search", blind)
    hit, _ = find_hits(graph, x, 0.98)
    assert beams == {48} and (hit == (x @ x.T >= 0.98)).all()


def test_similarities_found_in_single_precision_are_returned_in_double():
    x = unit(cloud(700, seed=7))
    graph = Graph(x)
    ids, sims = graph.search(x[:100], 48)
    assert graph.short.dtype == np.float32 and np.abs(sims - np.einsum("nd,nkd->nk", x[:100], x[ids])).max() < 1e-12
