"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Distinct vectors are dealt to shards per label, one graph is built per shard, and the vectors of every shard search every
shard of their label (each pair of shards once). A search keeps a beam of the best vectors seen; a vector whose beam is full
of hits is searched again with a wider beam, and a pair of shards whose audit against brute force falls short is searched
again with wider beams for all, which in shards of this size is a comparison with the whole shard. Links to other vectors are audited on their own. Cosines of what is found are checked in double precision.
Tasks return link counts and a forest of the links they found, not the links; the forests are united by components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import staged
from cyclelake.llm.components import components
from cyclelake.llm.topk import finite_vector

SHARD_ROWS = 8192
NEIGHBOURS = 12       # links a vector gets per layer; the lowest layer keeps twice as many
BUILD_BEAM, BEAM, WIDER = 48, 48, 4
BLOCK = 256           # vectors searched or added at once
SCAN, WIDE_SCAN = 8, 64   # a first beam, and a widened one, wider than these parts of the shard give way to comparing with all of it
AUDITED, RECALL = 48, 0.97   # audited vectors, and of those that have links
NEAREST = 5           # audits also ask for the nearest vectors


def _select(sims: np.ndarray, between: np.ndarray, m: int) -> np.ndarray:
    """For each row, up to m candidates (columns of ``sims``, -inf for none) in order of similarity, each closer to the
    row's vector than to any candidate chosen before; then the best of the others. -1 fills up."""
    rows, width = sims.shape
    chosen, count = np.full((rows, m), -1), np.zeros(rows, int)
    free, blocked, live = sims.copy(), np.full(sims.shape, -np.inf, sims.dtype), np.arange(rows)
    for k in range(min(m, width)):
        score = np.where(sims[live] > blocked[live], free[live], -np.inf)
        best = score.argmax(1)
        some = np.isfinite(score[np.arange(len(live)), best])
        live, best = live[some], best[some]
        if len(live) == 0:
            break
        chosen[live, k] = best
        count[live] += 1
        free[live, best] = -np.inf
        blocked[live] = np.maximum(blocked[live], between[live, best])
    rest = np.argsort(-free, axis=1)[:, :m]
    place = np.arange(m) - count[:, None]
    other = np.take_along_axis(rest, np.clip(place, 0, rest.shape[1] - 1), 1)
    usable = (place >= 0) & (place < rest.shape[1]) & np.isfinite(np.take_along_axis(free, other, 1))
    return np.where(usable, other, chosen)


class Graph:
    """A navigable small-world graph over unit vectors. Vectors are added in blocks that see the graph so far."""

    def __init__(self, vectors: np.ndarray, neighbours=NEIGHBOURS, beam=BUILD_BEAM, block=BLOCK):
        n = len(vectors)
        self._hold(vectors)
        rng = np.random.default_rng(n)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(neighbours)).astype(int), 6)
        self.links = [np.full((n, neighbours * (2 if layer == 0 else 1)), -1)
                      for layer in range((self.level.max() if n else 0) + 1)]
        self.entry = 0
        start, size = 0, 1
        while start < n:
            self._add(np.arange(start, min(n, start + size)), beam)
            start, size = start + size, min(block, start + size)

    def _hold(self, vectors: np.ndarray) -> None:
        """The way through the graph is found in single precision, what is found gets its similarity in double precision."""
        self.x, self.short = vectors, vectors.astype(np.float32)

    def _add(self, new: np.ndarray, beam: int) -> None:
        start = new[0]
        for layer in range(len(self.links)):
            mine = new[self.level[new] >= layer]
            if len(mine) == 0:
                continue
            ids = np.full((len(mine), 0), -1)
            if start:
                ids = self._walk(self.short[mine], beam, layer)
            own = np.where(np.eye(len(mine), dtype=bool), -1, mine[None, :])
            self._connect(mine, np.concatenate([ids, own], 1), layer)
        top = new[self.level[new].argmax()]
        if self.level[top] > self.level[self.entry] or start == 0:
            self.entry = top

    def _choose(self, nodes: np.ndarray, ids: np.ndarray, layer: int, most=64) -> np.ndarray:
        """Links of ``nodes`` out of the candidates ``ids`` (-1: none)."""
        sims = np.where(ids >= 0, np.einsum("nd,nkd->nk", self.short[nodes], self.short.take(ids, 0, mode="wrap")), np.float32(-np.inf))
        if ids.shape[1] > most:
            top = np.argpartition(-sims, most, axis=1)[:, :most]
            ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
        close = self.short.take(ids, 0, mode="wrap")
        places = _select(sims, close @ close.transpose(0, 2, 1), self.links[layer].shape[1])
        return np.where(places >= 0, np.take_along_axis(ids, np.maximum(places, 0), 1), -1)

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, layer: int) -> None:
        links = self.links[layer]
        links[nodes] = self._choose(nodes, ids, layer)
        source = np.repeat(nodes, links.shape[1])
        target = links[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        old = target < nodes[0]
        source, target = source[old], target[old]
        if len(target) == 0:
            return
        # The new links seen from their other end: the closest of them join that end's own links.
        order = np.lexsort((-np.einsum("nd,nd->n", self.short[source], self.short[target]), target))
        source, target = source[order], target[order]
        ends, first, sizes = np.unique(target, return_index=True, return_counts=True)
        room = links.shape[1]
        rank = np.arange(len(target)) - np.repeat(first, sizes)
        added = np.full((len(ends), room), -1)
        kept = rank < room
        added[np.repeat(np.arange(len(ends)), sizes)[kept], rank[kept]] = source[kept]
        for at in range(0, len(ends), BLOCK):
            part = slice(at, at + BLOCK)
            links[ends[part]] = self._choose(ends[part], np.concatenate([links[ends[part]], added[part]], 1), layer)

    def _descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """For each query, a near vector to start from in ``layer``."""
        at = np.full(len(queries), self.entry)
        best = queries @ self.short[self.entry]
        for upper in range(self.level[self.entry], layer, -1):
            moving = np.arange(len(queries))
            while len(moving):
                near = self.links[upper][at[moving]]
                sims = np.where(near >= 0, np.einsum("nd,nkd->nk", queries[moving], self.short[near]), -np.inf)
                step = sims.argmax(1)
                value = sims[np.arange(len(moving)), step]
                better = value > best[moving]
                at[moving[better]] = near[better, step[better]]
                best[moving[better]] = value[better]
                moving = moving[better]
        return at

    def search(self, queries: np.ndarray, beam: int, layer=0, expand=4) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` vectors that each query meets: ids (-1: none) and similarities."""
        ids = self._walk(queries.astype(np.float32), beam, layer, expand)
        return ids, np.where(ids >= 0, np.einsum("nd,nkd->nk", queries, self.x[ids]), -np.inf)

    def _walk(self, queries: np.ndarray, beam: int, layer=0, expand=4) -> np.ndarray:
        """The best ``beam`` vectors that each query meets (-1: none)."""
        n, every = len(queries), np.arange(len(queries))
        if self.level[self.entry] < layer:
            return np.full((n, 0), -1)
        ids = np.full((n, beam), -1)
        sims = np.full((n, beam), -np.inf, np.float32)
        done = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.x)), bool)
        ids[:, 0] = self._descend(queries, layer)
        sims[:, 0] = np.einsum("nd,nd->n", queries, self.short[ids[:, 0]])
        seen[every, ids[:, 0]] = True
        while True:
            waiting = np.where(done | (ids < 0), -np.inf, sims)
            count = min(expand, beam)
            places = np.argpartition(-waiting, count - 1, axis=1)[:, :count] if beam > count else np.tile(np.arange(beam), (n, 1))
            usable = np.isfinite(np.take_along_axis(waiting, places, 1))
            if not usable.any():
                return ids
            live = np.flatnonzero(usable.any(1))
            places, usable = places[live], usable[live]
            done[live[:, None], places] |= usable
            near = self.links[layer][ids[live[:, None], places]]
            near = np.where(usable[:, :, None], near, -1).reshape(len(live), -1)
            near.sort(1)
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            near = np.where(fresh, near, -1)
            rows, cols = np.nonzero(fresh)
            seen[live[rows], near[rows, cols]] = True
            new = np.full(near.shape, -np.inf, np.float32)
            new[rows, cols] = np.einsum("nd,nd->n", queries.take(live[rows], 0), self.short.take(near[rows, cols], 0))
            all_ids, all_sims = np.concatenate([ids[live], near], 1), np.concatenate([sims[live], new], 1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], 1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            done[live] = np.take_along_axis(all_done, top, 1)


def _linked(graph: Graph, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Queries that hit other vectors than themselves, the hits of each (a row of booleans), and whether these are all: by
    brute force, a block at a time in random order, until AUDITED such queries are found."""
    n, total = len(queries), len(graph.x)
    same = n == total and np.array_equal(queries, graph.x)
    order, found, hits = np.random.default_rng(n).permutation(n), [], []
    for at in range(0, n, BLOCK):
        part = order[at:at + BLOCK]
        hit = queries[part] @ graph.x.T >= threshold
        if same:
            hit[np.arange(len(part)), part] = False
        some = np.flatnonzero(hit.any(1))
        found.append(part[some])
        hits.append(hit[some])
        if sum(map(len, found)) >= AUDITED:
            return np.concatenate(found), np.concatenate(hits), at + BLOCK >= n
    return np.concatenate([np.zeros(0, int), *found]), np.concatenate([np.zeros((0, total), bool), *hits]), True


def find_hits(graph: Graph, queries: np.ndarray, threshold: float, beam=BEAM) -> tuple[np.ndarray, int]:
    """Which vector each query hits with at least ``threshold`` similarity (a boolean per pair of the two shards, so memory does not
    depend on how many hits there are), and the beam that passed the audits: of hits and nearest
    vectors of AUDITED queries, and of the hits other than themselves of AUDITED queries that have such hits. Where fewer
    have, brute force has found all hits by then, and they are added."""
    n, total, first = len(queries), len(graph.x), beam
    linked, links, complete = _linked(graph, queries, threshold)
    sample = np.unique(np.linspace(0, n - 1, min(n, AUDITED)).astype(int))
    truth = queries[sample] @ graph.x.T
    nearest = np.sort(truth, 1)[:, -min(NEAREST, total):][:, 0]
    wanted = (truth >= threshold) | (truth >= nearest[:, None] - 1e-12)
    hit = np.zeros((n, total), bool)
    while True:
        audited = np.zeros_like(wanted)
        for at in range(0, n, BLOCK):
            todo, width = np.arange(at, min(n, at + BLOCK)), beam
            while len(todo):
                if width * (SCAN if width == first else WIDE_SCAN) >= total:   # the widest beam: the whole shard
                    sims = queries[todo] @ graph.x.T
                    ids = np.broadcast_to(np.arange(total), sims.shape)
                    full = np.zeros(len(todo), bool)
                else:
                    ids, sims = graph.search(queries[todo], width)
                    full = sims.min(1) >= threshold
                settled = todo[~full]
                r, c = np.nonzero((sims[~full] >= threshold) & (ids[~full] >= 0))
                hit[settled[r], ids[~full][r, c]] = True
                inside = np.flatnonzero(np.isin(sample, settled))
                for k in inside:
                    met = ids[~full][np.searchsorted(settled, sample[k])]
                    audited[k, met[met >= 0]] = True
                # Where most beams are full, the shard is dense, and wider beams would be full as well.
                todo, width = todo[full], total if 2 * full.sum() > len(full) else width * WIDER
        passed = (audited & wanted).sum() >= RECALL * wanted.sum()
        if passed and len(linked):
            held = (hit[linked] & links).sum(1)
            passed = complete or held.sum() >= RECALL * links.sum() and (held / links.sum(1)).mean() >= RECALL
            if complete:
                hit[linked] |= links
        if beam * (SCAN if beam == first else WIDE_SCAN) >= total or passed:
            return hit, beam
        beam *= WIDER


def _verify(hit: np.ndarray, queries: np.ndarray, x: np.ndarray, threshold: float) -> None:
    """Takes the hits below ``threshold`` out. Cosines that rounding could move over it are summed once more, pair by pair."""
    for at in range(0, len(queries), BLOCK):
        part = slice(at, at + BLOCK)
        sims = queries[part] @ x.T
        q, c = np.nonzero(hit[part] & (np.abs(sims - threshold) < 1e-9))
        hit[part] &= sims >= threshold
        hit[part][q, c] = np.einsum("nd,nd->n", queries[part][q], x[c]) >= threshold


def _roots(hit: np.ndarray, columns: np.ndarray, rows: np.ndarray, nodes: int) -> np.ndarray:
    """For nodes 0 to ``nodes`` - 1, of which ``columns`` and ``rows`` belong to the matrix, the smallest one each reaches."""
    root = np.arange(nodes)
    while True:
        new = root.copy()
        for at in range(0, len(rows), BLOCK):
            block, own = hit[at:at + BLOCK], rows[at:at + BLOCK]
            new[own] = np.minimum(new[own], np.where(block, new[columns], nodes).min(1, initial=nodes))
            new[columns] = np.minimum(new[columns], np.where(block, new[own][:, None], nodes).min(0, initial=nodes))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _unit(values: bytes, dim: int) -> np.ndarray:
    x = np.frombuffer(values, np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)   # no overflow when squared
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """One row per shard: its vectors and its graph."""
    group = group.sort_values("rep")
    values = np.stack([np.asarray(v, np.float64) for v in group["vector"]])
    graph = Graph(_unit(values.tobytes(), values.shape[1]))
    return pd.DataFrame({
        "label": [group["label"].iloc[0]], "dim": [values.shape[1]], "shard": [group["shard"].iloc[0]],
        "reps": [group["rep"].to_numpy(np.int64).tobytes()], "times": [group["times"].to_numpy(np.int64).tobytes()],
        "vectors": [values.tobytes()], "entry": [int(graph.entry)],
        "level": [graph.level.astype(np.int8).tobytes()],
        "links": [[layer.astype(np.int32).tobytes() for layer in graph.links]],
    })


def _graph(row, dim: int) -> Graph:
    graph = Graph.__new__(Graph)
    graph._hold(_unit(row["vectors"], dim))
    graph.entry, graph.level = row["entry"], np.frombuffer(row["level"], np.int8)
    graph.links = [np.frombuffer(layer, np.int32).reshape(len(graph.x), -1) for layer in row["links"]]
    return graph


def _search(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        row = group.iloc[0]
        dim, same = int(row["dim"]), row["shard"] == row["shard_q"]
        graph, queries = _graph(row, dim), _unit(row["vectors_q"], dim)
        ids, asked = np.frombuffer(row["reps"], np.int64), np.frombuffer(row["reps_q"], np.int64)
        times, times_q = np.frombuffer(row["times"], np.int64), np.frombuffer(row["times_q"], np.int64)
        hit, _ = find_hits(graph, queries, threshold - 1e-9)
        if same:   # a pair that either end has found is a link of both
            hit |= hit.T
            np.fill_diagonal(hit, False)
        _verify(hit, queries, graph.x, threshold)
        # Copies: a vector that stands for t rows gives t links to each row on the other side.
        blocks = [slice(at, at + BLOCK) for at in range(0, len(hit), BLOCK)]
        by_query = np.concatenate([hit[b] @ times.astype(np.float64) for b in blocks])    # exact below 2^53
        columns = np.arange(len(ids))
        if same:
            nodes, rows, counts = ids, columns, by_query
        else:
            nodes, rows = np.concatenate([ids, asked]), len(ids) + np.arange(len(asked))
            counts = np.concatenate([sum(times_q[b].astype(np.float64) @ hit[b] for b in blocks), by_query])
        root = _roots(hit, columns, rows, len(nodes))
        touched = np.flatnonzero(counts)
        return pd.DataFrame({
            "node": np.concatenate([nodes[touched], nodes[touched]]),
            "other": np.concatenate([nodes[touched], nodes[root[touched]]]),
            "links": np.concatenate([counts[touched].astype(np.int64), np.zeros(len(touched), np.int64)]),
        })

    return run


def near_vectors(df: DataFrame, threshold=0.98, shard_rows=SHARD_ROWS, id_column="vec_id", vector="embedding",
                 label="label") -> DataFrame:
    """id, n_links, component_id, kept: one row per input row.

    Rows link when their labels are equal and not null, their vectors have one length, and the cosine in double precision is
    at least ``threshold`` (not below -1). Null and zero vectors and those with null or non-finite components link with
    nothing, nor do rows without an id (component_id null, not kept). n_links counts rows, so copies link with each other;
    component_id is the smallest id reachable. Repeated rows count as copies. Other columns are not read. Links are found
    by approximate search whose recall is audited per pair of shards; no found link is below the threshold.
    """
    x = F.col(vector)
    usable = finite_vector(vector) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))
    usable = usable & F.col(id_column).isNotNull() & F.col(label).isNotNull()
    doubles = F.transform(x, lambda v: v.cast("double"))
    rows = df.select(F.col(id_column).cast("bigint").alias("_id"), F.when(usable, F.col(label)).alias("label"),
                     F.when(usable, doubles).alias("vector")).withColumns({
                         "k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(7), "vector")})
    rows = staged(rows.withColumns({k: F.when(F.col("vector").isNotNull(), F.col(k)) for k in ("k1", "k2")}), "vectors")
    keys = ["label", "k1", "k2"]
    distinct = rows.filter(F.col("vector").isNotNull()).groupBy(*keys).agg(
        F.min("_id").alias("rep"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"))
    distinct = staged(distinct.withColumn("dim", F.size("vector")), "distinct")
    shards = distinct.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("_shards"))
    dealt = distinct.join(staged(shards, "shards"), ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("rep"), F.col("_shards")).cast("int"))
    label_type = df.schema[label].dataType.simpleString()
    index = staged(dealt.select("label", "dim", "shard", "rep", "times", "vector").groupBy("label", "dim", "shard").applyInPandas(
        _build, f"label {label_type}, dim int, shard int, reps binary, times binary, vectors binary, entry int, level binary, "
                "links array<binary>"), "graphs")
    asked = index.select("label", "dim", *[F.col(c).alias(f"{c}_q") for c in ("shard", "reps", "times", "vectors")])
    pairs = index.join(asked, ["label", "dim"]).filter(F.col("shard") <= F.col("shard_q"))
    found = staged(pairs.groupBy("label", "dim", "shard", "shard_q").applyInPandas(
        _search(threshold), "node bigint, other bigint, links bigint"), "found")
    parts = components(found.filter(F.col("node") != F.col("other")), "node", "other")
    sums = found.groupBy("node").agg(F.sum("links").alias("_links"))
    named = distinct.select(*keys, "rep", "times").join(sums, F.col("rep") == F.col("node"), "left").drop("node").join(
        parts, F.col("rep") == F.col("node"), "left")
    named = staged(named.select(*keys, (F.coalesce("_links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                                F.coalesce("component", "rep").alias("_component")), "named")
    out = rows.drop("vector").join(named, keys, "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    return out.select(F.col("_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"))
