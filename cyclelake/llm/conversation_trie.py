"""Prefix tries of conversations from adaptive radix trees over fixed-width turn ids.

A turn (role and text) becomes a 16-byte id, a rebuilt conversation the concatenation of its ids: a big-endian key. Keys are
range-partitioned; every task puts its keys, a few megabytes at a time, into an adaptive radix tree and emits the nodes at
byte depths that are whole turns, with partial counts. Nodes of different trees that stand for the same turns carry the
same name, two hashes that add up turn by turn, and are summed after a map-side combine, however many members they have.

What a subtree sums up is a sum over members as well. A node belongs to its smallest member; a member owns the last part of
its path (or nothing), so every node and every childless node is counted with one member: a second pass over the keys sums
what members bring along. Long conversations are cut into segments, whose trees start at the named node the one before ends at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.functions.joins import join_per_key
from cyclelake.functions.ordered import OrderedSeries
from cyclelake.llm.common import staged, text_or_empty
from cyclelake.llm.radix_tree import RadixTree

ID_BYTES = 16
SEGMENT = 256             # turns of a conversation in one key
TREE_BYTES = 2_000_000    # of keys in one tree
FAMILY, HEADS = 5, 9      # conversations that share a head; heads have fewer turns than this
SLOT = 100_000            # turn numbers in a slice of a conversation that is numbered in slices
PRIME = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51, 0x0E6546B64A3F1C2D)
NAME = ["depth", "s1", "s2"]


def _powers(first: int, count: int) -> list[tuple[int, int]]:
    """The factors of the turns at depth ``first`` and after."""
    out = [tuple(pow(b, first, PRIME) for b in BASES)]
    for _ in range(count - 1):
        out.append(tuple(p * b % PRIME for p, b in zip(out[-1], BASES)))
    return out


def _add(s1: int, s2: int, turn: bytes, power: tuple[int, int]) -> tuple[int, int]:
    return ((s1 + int.from_bytes(turn[:8], "big") * power[0]) % PRIME,
            (s2 + int.from_bytes(turn[8:], "big") * power[1]) % PRIME)


def turns_of(df: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv, id, size, pos): every turn with its place in its conversation, from 1."""
    role_text, said = text_or_empty(role), text_or_empty(text)
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role_text).cast("string"), F.lit(":"), role_text, said), 256),
                                 1, 2 * ID_BYTES))
    turns = staged(df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.coalesce(F.col(turn).cast("bigint"), F.lit(-2 ** 63)).alias("turn"),
        F.col(turn).isNotNull().alias("known"), digest.alias("id"), F.octet_length(said).cast("bigint").alias("size")), "turns")
    series = OrderedSeries(turns, ["conv"], ["turn", "known", "id"], SLOT, numeric=True)
    return series.with_row_number("pos").select("conv", "id", "size", "pos")


def rebuilt(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Segments (conv, seg, start, key, sizes) of the rebuilt conversations, each conversation with at least one, and per
    conversation (conv, top: its last segment, total: bytes of its texts)."""
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS))
    entry = F.struct("pos", "id", "size")
    heads = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS)).groupBy("conv").agg(
        F.sort_array(F.collect_list(entry)).alias("head")).select(F.col("conv").alias("base"), "head")
    number = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("pos") - head - 1) / segment))
    own = turns.withColumn("seg", number).groupBy("conv", "seg").agg(
        F.sort_array(F.collect_list(F.when(F.col("pos") > head, entry))).alias("own"))
    none = F.slice("own", 1, 0)
    both = own.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(heads, "base", "left").withColumn(
        "head", F.coalesce(F.slice("head", F.lit(1), head.cast("int")), none))
    all_turns = F.when(F.col("seg") == 0, F.concat("head", "own")).otherwise(F.col("own"))
    segments = both.select(
        "conv", "seg", all_turns.alias("turns"),
        F.when(F.col("seg") == 0, F.lit(0)).otherwise(F.size("head") + F.col("seg") * segment).cast("bigint").alias("start"))
    segments = staged(segments.select(
        "conv", "seg", "start", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.id)), "")).alias("key"),
        F.transform("turns", lambda t: t.size).alias("sizes")), "segments")
    size = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return segments, staged(segments.groupBy("conv").agg(F.max("seg").alias("top"), F.sum(size).alias("total")), "convs")


def _named(segments: DataFrame, convs: DataFrame) -> DataFrame:
    """The segments with the name of the node they start at (s1, s2), the bytes of text before, and whether they are the last."""
    whole = segments.join(convs, "conv").withColumn("last", F.col("seg") == F.col("top"))
    many = whole.filter("top > 0")
    if many.isEmpty():
        return whole.withColumns({n: F.lit(0).cast("bigint") for n in ("s1", "s2", "before")}).drop("top", "total")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, seg, start, key, sizes in batch.itertuples(index=False):
                s1 = s2 = 0
                for i, power in enumerate(_powers(start + 1, len(key) // ID_BYTES)):
                    s1, s2 = _add(s1, s2, key[i * ID_BYTES:(i + 1) * ID_BYTES], power)
                rows.append((conv, seg, s1, s2, sum(sizes)))
            yield pd.DataFrame(rows, columns=["conv", "seg", "s1", "s2", "before"])

    own = many.select("conv", "seg", "start", "key", "sizes").mapInPandas(
        sums, "conv bigint, seg bigint, s1 bigint, s2 bigint, before bigint")
    earlier = W.partitionBy("conv").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")).over(earlier), F.lit(0))
    states = own.select("conv", "seg", *[(upto(c) % PRIME).cast("bigint").alias(c) for c in ("s1", "s2")],
                        upto("before").cast("bigint").alias("before"))
    joined = whole.join(staged(states, "states"), ["conv", "seg"], "left").drop("top", "total")
    return joined.fillna(0, ["s1", "s2", "before"])


class _Found:
    """Rows of nodes, column by column."""

    def __init__(self, columns):
        self.columns = {c: [] for c in columns}
        self.adds = [v.append for v in self.columns.values()]

    def row(self, *values):
        for add, value in zip(self.adds, values):
            add(value)


def _emit(found: _Found, tree: RadixTree, start: int, s1: int, s2: int, before: int, sizes: dict) -> None:
    """The nodes of one tree that lie at whole turns. A value is [members, least member, sums ..., ends]."""
    order, stats, at = tree.parents_first(), {}, {}
    for node, parent, _ in reversed(order):
        own = stats.pop(id(node), None)
        if node.value is not None:
            own = node.value[:-1] if own is None else [own[0] + node.value[0], min(own[1], node.value[1]),
                                                       *[x + y for x, y in zip(own[2:], node.value[2:-1])]]
        at[id(node)] = own
        if parent is not None:
            up = stats.get(id(parent))
            stats[id(parent)] = own if up is None else [up[0] + own[0], min(up[1], own[1]),
                                                        *[x + y for x, y in zip(up[2:], own[2:])]]
    powers = [()]
    places = {}
    for node, parent, byte in order:
        own = at[id(node)]
        ends = node.value[-1] if node.value is not None else None
        if parent is None:
            place = (0, b"", s1, s2, before, 0)
            if start == 0:
                found.row(0, 0, 0, None, None, 0, 0, *own, ends)
        else:
            depth, rest, a, b, done, last = places[id(parent)]
            path = rest + bytes((byte,)) + node.prefix
            whole = len(path) // ID_BYTES
            while len(powers) <= depth + whole:
                powers += _powers(start + len(powers), max(8, len(powers)))
            for i in range(whole):
                turn = path[i * ID_BYTES:(i + 1) * ID_BYTES]
                above, (a, b) = (a, b), _add(a, b, turn, powers[depth + i + 1])
                done, last = done + last, sizes[turn]
                found.row(start + depth + i + 1, a, b, *above, last, done, *own,
                          ends if (i + 1) * ID_BYTES == len(path) else None)
            place = (depth + whole, path[whole * ID_BYTES:], a, b, done, last)
        places[id(node)] = place


def _tries(weights: list[str], with_ends: bool):
    columns = [*NAME, "p1", "p2", "size", "before", "n", "least", *weights, "ends"]

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        trees, sizes = {}, {}
        for conv, start, s1, s2, before, key, lengths, last, *brought in rows.itertuples(index=False):
            tree = trees.get((start, s1, s2))
            if tree is None:
                tree = trees[start, s1, s2] = (RadixTree(), before)
            for i, length in enumerate(lengths):
                sizes[key[i * ID_BYTES:(i + 1) * ID_BYTES]] = length
            node = tree[0].slot(key)
            ends = [conv] if last and with_ends else None
            if node.value is None:
                node.value = [1, conv, *brought, ends]
            else:
                old = node.value
                both = (old[-1] or []) + ends if ends else old[-1]
                node.value = [old[0] + 1, min(old[1], conv), *[x + y for x, y in zip(old[2:-1], brought)], both]
        found = _Found(columns)
        for (start, s1, s2), (tree, before) in trees.items():
            _emit(found, tree, start, s1, s2, before, sizes)
        out = pd.DataFrame({c: pd.array(v, "Int64") if c != "ends" else v for c, v in found.columns.items()})
        out["first_end"] = pd.array([min(e) if e else None for e in out["ends"]], "Int64")
        out["ends"] = [",".join(map(str, sorted(e))) if e else None for e in out["ends"]]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part = batch["key"].map(len).cumsum() // TREE_BYTES
            for _, rows in batch.groupby(part, sort=True):
                yield build(rows)

    schema = ", ".join(f"{c} bigint" for c in [*columns[:-1], "first_end"]) + ", ends string"
    return run, schema


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per node over its ids, which come in order and in as many pieces as there are."""
    current, state = None, None
    for batch in batches:
        done = []
        for *name, ends in batch[[*NAME, "ends"]].itertuples(index=False):
            if name == current:
                state.update(b",")
            else:
                if current is not None:
                    done.append((*current, state.hexdigest()))
                current, state = name, hashlib.sha256()
            state.update(ends.encode())
        yield pd.DataFrame(done, columns=[*NAME, "ends_sha256"])
    if current is not None:
        yield pd.DataFrame([(*current, state.hexdigest())], columns=[*NAME, "ends_sha256"])


def prefix_trie(df: DataFrame, segment: int = SEGMENT, **columns) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node of the trie
    of all rebuilt conversations.

    Turns are ordered by number, those without one first; turns of one number by the hash of role and text, so that
    repeated rows are repeated turns in either order. Null role or text is empty. Rows without a conv_id belong to no
    conversation; ids are whole numbers, and the head of a conversation is taken from conv_id - conv_id % 5 with the remainder's sign
    as in SQL. An empty table has no node, not even the root. Texts of any length count as a whole: they are hashed to
    16 bytes, and only the hash and the length go on. Other columns are not read.
    """
    segments, convs = rebuilt(turns_of(df, **columns), segment)
    by = ["start", "s1", "s2", "key", "conv"]
    named = staged(_named(segments, convs), "named")
    brought = ["conv", "start", "s1", "s2", "before", "key", "sizes", "last"]
    run, schema = _tries([], True)
    ranged = named.select(*brought).repartitionByRange(*by).sortWithinPartitions(*by)
    raw = staged(ranged.mapInPandas(run, schema), "partial")
    nodes = staged(raw.groupBy(*NAME).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "size", "before")], F.sum("n").alias("n"), F.min("least").alias("least")), "nodes")
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"),
                                             F.col("p2").alias("s2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(kids, NAME, "left").fillna(0, ["n_children"]), "grown")
    owned = nodes.groupBy(F.col("least").alias("conv")).agg(
        F.min("before").alias("shared"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    # What a member has read before its own nodes begin: all of it, if it owns none.
    members = staged(convs.join(owned, "conv", "left").select(
        "conv", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaves", F.lit(0)).alias("leaves")), "members")
    run, schema = _tries(["shared", "leaves"], False)
    sums = named.join(members, "conv").select(*brought, "shared", "leaves").mapInPandas(run, schema).groupBy(*NAME).agg(
        F.sum("shared").alias("shared"), F.sum("leaves").alias("n_leaves"))
    ends = raw.filter(F.col("ends").isNotNull()).select(*NAME, "first_end", "ends")
    hashes = ends.repartition(*NAME).sortWithinPartitions(*NAME, "first_end").mapInPandas(
        _hashes, "depth bigint, s1 bigint, s2 bigint, ends_sha256 string")
    known = nodes.join(staged(sums, "sums"), NAME).join(staged(hashes, "hashes"), NAME, "left")
    first = members.select(F.col("conv").alias("least"), F.col("shared").alias("_first"))
    known = staged(known.join(first, "least").select(
        F.struct(*NAME).alias("node"), F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"),
                                                F.col("p1").alias("s1"), F.col("p2").alias("s2"))).alias("above"),
        "s1", "depth", F.col("least").alias("conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("shared") - F.col("_first") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "known")
    parents = known.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return join_per_key(known, parents, "above", "left", spread_by="s1").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
