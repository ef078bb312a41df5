import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.llm.topk import _met, _tiles, products, top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def brute(rows, k=20):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in usable:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(v) == len(w))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"tile_rows": 7, "query_rows": 3, "fan_in": 2}])
def test_equals_brute_force(spark, options):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)], 0) for i in range(260)]
    rows += [(i, [0.5] * 6, 0) for i in range(300, 345)]                       # ties
    rows += [(400, None, 0), (401, [None] * 6, 0), (420, [float("nan")] * 6, 0), (421, [float("inf")] * 6, 0),
             (440, [0.1, 0.2], 0), (441, [0.3, -0.2], 0), (460, [], 0), (None, [1.0] * 6, 0), (480, [0.0] * 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")).repartition(4)
    assert sorted(map(tuple, top_k(df, **options).collect())) == brute(rows)


def test_large_numbers_stay_exact():
    a = np.array([[2.0 ** 31, 3.0]])
    assert products(a, np.array([[2.0 ** 30, 1.0]])).tolist() == [[2 ** 61 + 3]]


def test_empty(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_numbering_shuffles_no_matrix(spark):
    rows = [(i, [float(i), 1.0] if i % 3 else [float(i)]) for i in range(100)]
    tiles = _tiles(spark.createDataFrame(rows, "_id long, _x array<double>").repartition(5), 4, "tiles")
    numbers = {}
    for r in tiles.collect():
        numbers.setdefault(r.dim, []).append(r.tile)
    assert all(sorted(own) == list(range(len(own))) for own in numbers.values()) and set(numbers) == {1, 2}
    # Written by the tasks that packed them, not by the one that numbers them.
    assert len({n for n in tiles.select(F.spark_partition_id()).distinct().collect()}) > 1
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert not any("values" in line for line in plan.splitlines() if "Window" in line or "Exchange hash" in line)
    for side in _met(tiles, tiles, 2):
        assert "SortMergeJoin" not in side._jdf.queryExecution().executedPlan().toString()
        assert side.filter("dim = 2").select(F.spark_partition_id()).distinct().count() > 1
