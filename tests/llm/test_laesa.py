import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclelake.llm.laesa import choose_pivots, cluster_report, cluster_vectors, nearest

SCHEMA = "vec_id bigint, embedding array<float>, cluster string"


def plain(rows, clusters, rounds, dims, scale=256):
    """The same by definition, with Python's integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((far(v, c), k) for k, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = {k: sum(d for d, c in found if c == k) for k in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i is not None, i or 0, c, d, total[c], sum(total.values()), sha[c]) for (i, _), (d, c) in zip(kept, found))


def shown(df):
    return sorted((r.vec_id is not None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_definition(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.01, 1, 30])]) for i in range(300)]
    rows += [rows[5], (7, rows[9][1]), (None, rows[3][1]), (400, None), (401, [1.0] * 7), (402, [1.0] * 7 + [None]),
             (403, [math.nan] * 8), (404, [math.inf] * 8), (405, [0.0] * 8), (406, [0.0] * 8)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = cluster_report(df, clusters=9, rounds=4, dims=8, pivots=3)
    assert shown(got) == plain(rows, 9, 4, 8)


def test_few_empty_and_equal_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cluster_report(empty).collect() == []
    rows = [(i, [0.5] * 4) for i in range(6)]
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    assert shown(cluster_report(df, clusters=40, dims=4)) == plain(rows, 40, 5, 4)      # ties go to the smaller number
    assert cluster_vectors(df.withColumn("vec_id", F.col("vec_id").cast("string")), dims=4)[0].count() == 6


def test_pivots_bound_without_loss_and_spare_work():
    rng = np.random.default_rng(4)
    centres = rng.integers(-5000, 5000, (40, 16))
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-60, 60, (3000, 16))
    pivots = choose_pivots(x[:256], 12)
    near = np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1).astype(float))
    cluster, distance, compared = nearest(x, near, pivots, centres)
    every = ((x[:, None, :] - centres) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (cluster == every.argmin(axis=1)).all()
    assert compared < 0.2 * every.size
