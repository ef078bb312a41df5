"""Exact top-k search by tiled matrix products.

Vectors are turned into integers and laid out in tiles (matrices of some thousand rows); every tile of queries meets
every tile of candidates. A task multiplies one query tile with a bounded number of candidate tiles and keeps the best
k per query while it goes; the lists of the tasks are then merged, a bounded number at a time, until one is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.llm.common import staged

TILE_ROWS = 4096     # candidates of a tile
QUERY_ROWS = 1024    # queries of a tile
FAN_IN = 16          # candidate tiles of a task, and lists merged at once
EXACT = 1 << 53      # integers that doubles hold exactly


def finite_vector(column: str) -> Column:
    """Whether a vector is there, and all its components are."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad, F.lit(False))


def _tiles(df: DataFrame, rows: int, name: str) -> DataFrame:
    """(dim, tile, ids, values): vectors of one length, ``rows`` at most, as packed matrices. Made where the rows are. Tiles
    are numbered by the task that made them (one row per task and dim says where its numbers start), so that matrices are
    never shuffled for it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        made: dict[int, int] = {}
        task = TaskContext.get().partitionId()

        def tile(dim, kept):
            made[dim] = made.get(dim, 0) + 1
            ids = np.array([i for i, _ in kept], np.int64)
            values = np.array([v for _, v in kept], np.float64).reshape(len(kept), dim)
            return pd.DataFrame({"dim": [dim], "task": [task], "number": [made[dim] - 1], "ids": [ids.tobytes()], "values": [values.tobytes()]})

        for batch in batches:
            for i, v in zip(batch["_id"], batch["_x"]):
                kept = waiting.setdefault(len(v), [])
                kept.append((i, v))
                if len(kept) == rows:
                    yield tile(len(v), waiting.pop(len(v)))
        for dim, kept in waiting.items():
            yield tile(dim, kept)

    packed = staged(df.mapInPandas(run, "dim int, task int, number bigint, ids binary, values binary"), name)
    counts = packed.groupBy("dim", "task").agg(F.count(F.lit(1)).alias("_tiles"))
    before = W.partitionBy("dim").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("dim", "task", F.coalesce(F.sum("_tiles").over(before), F.lit(0)).alias("_start"))
    numbered = packed.join(F.broadcast(starts), ["dim", "task"])
    return numbered.select("dim", (F.col("_start") + F.col("number")).alias("tile"), "ids", "values")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued matrices. Doubles are exact, and fast, while no sum can pass 2**53; beyond
    that Python's integers are used."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if bound < EXACT:
        return queries @ candidates.T
    return np.array([[int(x) for x in row] for row in queries], object).reshape(queries.shape) @ np.array(
        [[int(x) for x in row] for row in candidates], object).reshape(candidates.shape).T


def _search(k: int):
    def run(group: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        row = asked.iloc[0]
        dim, ids = int(row["dim"]), np.frombuffer(row["q_ids"], np.int64)
        queries = np.frombuffer(row["q_values"], np.float64).reshape(len(ids), dim)
        kept_ids = [np.zeros(0, np.int64)] * len(ids)
        kept = [np.zeros(0)] * len(ids)
        for other, values in zip(group["ids"], group["values"]):
            other = np.frombuffer(other, np.int64)
            scores = products(queries, np.frombuffer(values, np.float64).reshape(len(other), dim))
            for n in range(len(ids)):
                mine = other != ids[n]
                all_ids = np.concatenate([kept_ids[n], other[mine]])
                all_scores = np.concatenate([kept[n], scores[n][mine]])
                top = best(all_scores, all_ids, k)
                kept_ids[n], kept[n] = all_ids[top], all_scores[top]
        sizes = [len(x) for x in kept]
        return pd.DataFrame({
            "query_id": np.repeat(ids, sizes), "node": int(row["node"]), "vec_id": np.concatenate(kept_ids),
            "score": np.array([int(x) for x in np.concatenate(kept)], np.int64),
        })

    return run


def _met(candidates: DataFrame, queries: DataFrame, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """Candidate and query tiles, each repeated for the (dim, q_tile, node) it takes part in. Only tile numbers are broadcast,
    so that the tiles of a dim are not brought together."""
    noded = candidates.withColumn("node", F.floor(F.col("tile") / fan_in))
    asked = queries.select("dim", F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))
    return (noded.join(F.broadcast(queries.select("dim", F.col("tile").alias("q_tile"))), "dim"),
            asked.join(F.broadcast(candidates.select("dim", F.floor(F.col("tile") / fan_in).alias("node")).distinct()), "dim"))


def top_k(df: DataFrame, k=20, scale=64, query_step=20, id_column="vec_id", vector="embedding",
          tile_rows=TILE_ROWS, query_rows=QUERY_ROWS, fan_in=FAN_IN) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each row whose id is divisible by ``query_step``.

    Components become floor(scale * x) in double precision, the score is the integer inner product, ties go to the
    smaller id. Every row but the query's own is a candidate; repeated rows with the query's id are its own. Null vectors,
    and those with null or non-finite components, take no part, nor do null ids; vectors of different lengths do not
    meet; empty vectors score 0 with each other. Scores must fit 64 bits. Other columns are not read.
    """
    usable = df.filter(finite_vector(vector) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")).alias("_x"))
    candidates = _tiles(usable, tile_rows, "tiles")
    queries = _tiles(usable.filter(F.col("_id") % query_step == 0), query_rows, "queries")
    keys = ["dim", "q_tile", "node"]
    met, asked = _met(candidates, queries, fan_in)
    lists = staged(met.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        _search(k), "query_id bigint, node bigint, vec_id bigint, score bigint"), "lists")
    nodes = (lists.agg(F.max("node")).first()[0] or 0) + 1
    while True:
        nodes, last = -(-nodes // fan_in), nodes <= fan_in
        lists = lists.withColumn("node", F.floor(F.col("node") / fan_in))
        order = W.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if last:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = staged(lists.drop("rank"), "lists")
