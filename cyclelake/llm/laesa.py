"""Centroid clustering with a pivot table.

Every vector is turned into integers, and its distances to a few fixed pivots are stored once. In each round the pivots'
distances to the centroids are computed, and the triangle inequality bounds every centroid's distance to a vector from
below. Only centroids whose bound does not exceed the distance to the most promising one are compared exactly, in integers.
The rounds pass over the stored table; a task sends back one row of sums per cluster, and only centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import staged

LARGEST = 2 ** 27    # of a component as integer: sums of 64 squared differences then fit 64 bits
SAMPLE = 256         # vectors that the pivots are chosen from


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x from the vector y."""
    d = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Rows of the sample that lie far apart: each next one has the largest sum of distances to those chosen before."""
    if not len(sample):
        return sample
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(pivots, len(sample)):
        total += np.sqrt(_squared(sample, sample[chosen[-1]]))
        total[chosen] = -1
        chosen.append(int(np.argmax(total)))
    return sample[chosen]


def nearest(x: np.ndarray, near: np.ndarray, pivots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per row of x the nearest centroid (ties: the smaller number), its squared distance, and how many exact distances were
    computed. ``near`` holds the rows' distances to the pivots."""
    to_pivots = np.sqrt(np.stack([_squared(pivots, c) for c in centroids]))
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(near[:, p:p + 1] - to_pivots[:, p]), out=bound)
    # What rounding can add to a difference of two roots; a bound is lowered by it.
    bound -= 1e-6 + 1e-9 * (near.max(axis=1, initial=0)[:, None] + to_pivots.max(axis=1, initial=0))
    cluster = np.argmin(bound, axis=1)
    distance = np.empty(len(x), np.int64)
    for c in np.unique(cluster):
        rows = np.flatnonzero(cluster == c)
        distance[rows] = _squared(x[rows], centroids[c])
    first, compared = cluster.copy(), len(x)
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= np.sqrt(distance)) & (first != c))
        compared += len(rows)
        exact = _squared(x[rows], centroids[c])
        better = (exact < distance[rows]) | ((exact == distance[rows]) & (c < cluster[rows]))
        cluster[rows[better]], distance[rows[better]] = c, exact[better]
    return cluster, distance, compared


def _pivot_table(vectors: DataFrame, pivots: np.ndarray, dims: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * _matrix(batch.column("values"), dims)).astype(np.int32)
            near = np.sqrt(np.stack([_squared(x, p) for p in pivots], axis=1))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), _lists(x.ravel(), dims, pa.int32()), _lists(near.ravel(), len(pivots), pa.float64()),
            ], ["id", "x", "near"])

    return staged(vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, x array<int>, near array<double>"),
                  "pivots")


def _lists(flat: np.ndarray, width: int, kind) -> pa.ListArray:
    offsets = np.arange(0, len(flat) + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _assigned(batch: pa.RecordBatch, pivots, centroids):
    x = _matrix(batch.column("x"), centroids.shape[1])
    return x, *nearest(x, _matrix(batch.column("near"), len(pivots)), pivots, centroids)


def _moved(table: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; those without vectors stay."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            x, cluster, _, _ = _assigned(batch, pivots, centroids)
            for c in np.unique(cluster):
                rows = x[cluster == c]
                count[c] += len(rows)
                total[c] += rows.sum(axis=0, dtype=np.int64)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(held, pa.int32()), pa.array(count[held]), _lists(total[held].ravel(), dims, pa.int64())],
            ["cluster", "n", "total"])

    sums = table.select("x", "near").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    each = sums.select("cluster", "n", F.posexplode("total").alias("dim", "part")).groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    moved = centroids.copy()
    for row in each.collect():     # clusters times components
        moved[row.cluster, row.dim] = int(row.total) // row.n
    return moved


def cluster_vectors(df: DataFrame, clusters=40, rounds=5, dims=64, scale=256, seed="2", pivots=12, id_column="vec_id",
                    vector="embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, and the final centroids.

    Usable are vectors of exactly ``dims`` components, none null or non-finite, whose integers floor(scale * x) stay within
    2^27 (beyond, a squared distance need not fit 64 bits); the others have no row. The first centroids are the vectors
    whose sha256 of ``seed:id`` is smallest (fewer, if there are fewer vectors); of rows with one id those with smaller
    components come first, rows without an id last. Repeated rows are vectors of their own. An empty table gives no rows.
    Other columns are not read. The driver holds the centroids and the sample that pivots are chosen from (256 vectors).
    """
    inside = lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= LARGEST / scale)
    usable = df.select(F.col(id_column).alias("id"), F.col(vector).alias("values")).filter(
        (F.size("values") == dims) & F.forall("values", inside)).withColumn("values", F.col("values").cast("array<double>"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    picked = usable.orderBy(order, F.col("id"), "values").limit(max(SAMPLE, clusters)).collect()
    sample = np.floor(scale * np.array([r.values for r in picked], float)).astype(np.int64).reshape(-1, dims)
    centroids, fixed = sample[:clusters], choose_pivots(sample, pivots)
    kind = usable.schema["id"].dataType.simpleString()
    schema = f"id {kind}, cluster int, distance bigint"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], schema), centroids
    table = _pivot_table(usable, fixed, dims, scale)
    for _ in range(rounds):
        moved = _moved(table, fixed, centroids)
        if np.array_equal(moved, centroids):    # later rounds would change nothing
            break
        centroids = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance, _ = _assigned(batch, fixed, centroids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                                             ["id", "cluster", "distance"])

    return table.mapInArrow(run, schema), centroids


def cluster_report(df: DataFrame, id_column="vec_id", **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per usable vector of
    ``cluster_vectors``, with the sums of distances over its cluster and over all, and the hash of its final centroid."""
    rows, centroids = cluster_vectors(df, id_column=id_column, **options)
    rows = staged(rows, "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint")
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(wide.alias("total")).collect()}    # one row per cluster
    facts = [(c, t, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, t in sums.items()]
    known = df.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
