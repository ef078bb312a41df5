"""N-gram Jaccard self-join by vertical partitioning.

1. Screening. Two sets that are similar enough share a known number of shingles among the smallest of each (in hash order).
   Documents are packed into slices; a slice sends each of these shingles once, as 32 bits, to the fragment of the hash
   range it falls in, and fragments tell which ones occur elsewhere. Documents with too few of them have no partner.
   What remains is documents with copies or mostly shared text.
2. Classes. Documents with equal sets are one node from here on.
3. Global order. Shingles of the remaining nodes are ordered by how many nodes hold them, rarest first, and the order is
   cut into fragments. The overlap of a pair is counted in each fragment on its own and summed per pair.
4. Stars. Nodes with equal minimum hashes are compared with the most typical of them only, so a group of n near copies
   costs about n comparisons. Linked nodes form first components.
5. All other pairs. Nodes of different components that share a shingle in their prefix of the global order are compared,
   stars as a whole at first. Pairs inside a component are already connected and are never built. No link between
   components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import release_memory, staged, text_or_empty
from cyclelake.llm.components import components

SLICE_BYTES = 4_000_000      # text of a slice
SLICE_DOCS = 60_000          # at most, because places in a slice are 16-bit numbers
FRAGMENT_BYTES = 16_000_000  # text behind a screening fragment
LEAST_FRAGMENTS = 32
FRAGMENTS = 4                # of the global order
STAR_KEYS = 3
KNOWN = 300_000              # words a worker remembers
SHARED = 65_535              # place of a shingle that several documents of a slice hold
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MULTIPLIERS[1]
    return (x ^ (x >> np.uint64(32))) * MULTIPLIERS[2]


def shingle_set(raw: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles. ASCII letters are folded; blanks are ASCII only."""
    tokens = raw.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > KNOWN:
        _WORDS.clear()
    hashes = np.fromiter(map(_WORDS.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    out = np.full(len(tokens) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * MULTIPLIERS[0] + hashes[k:k + len(out)])
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def least_overlap(n: int, threshold: int) -> int:
    """What a set of size n shares at least with a similar one."""
    return -(-threshold * n // 100)


def _extra(n: int) -> int:
    """How many shingles two similar sets share among their smallest, beyond the first."""
    return max(1, n // 5)


class _Slice:
    """Documents packed together for screening."""

    def __init__(self, number: int, fragments: int, threshold: int):
        self.number, self.fragments, self.threshold = number, fragments, threshold
        self.size, self.docs, self.parts, self.owners = 0, [], [], []
        self.digests: set[bytes] = set()

    def add(self, doc_id, size: int, found: np.ndarray) -> None:
        digest, place = xxhash.xxh3_128_digest(found.tobytes()), len(self.docs)
        self.docs.append((doc_id, len(found), digest))
        self.size += size
        if len(found) and digest not in self.digests:   # copies inside a slice send nothing
            self.digests.add(digest)
            n = len(found)
            prefix = found[: n - least_overlap(n, self.threshold) + _extra(n)]
            self.parts.append(prefix)
            self.owners.append(np.full(len(prefix), place, np.int64))

    def rows(self) -> pd.DataFrame:
        ids, sizes, digests = zip(*self.docs)
        docs = pd.DataFrame({
            "slice": self.number, "place": np.arange(len(ids)), "doc_id": pd.array(ids, "Int64"),
            "n": pd.array(sizes, "Int64"), "digest": digests, "fragment": -1, "rest": b"", "owner": b"",
        })
        if not self.parts:
            return docs.assign(shared=0)
        hashes, owners = np.concatenate(self.parts), np.concatenate(self.owners)
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], owners[order]
        first = np.append(True, hashes[1:] != hashes[:-1])
        several = np.diff(np.append(np.flatnonzero(first), len(hashes))) > 1
        docs["shared"] = np.bincount(owners[np.repeat(several, np.diff(np.append(np.flatnonzero(first), len(hashes))))],
                                     minlength=len(ids))
        kept, place = hashes[first], np.where(several, SHARED, owners[first]).astype(np.uint16)
        fragment = ((kept >> np.uint64(32)) * np.uint64(self.fragments) >> np.uint64(32)).astype(np.int64)
        rest = (kept & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cuts = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
        ends = np.append(cuts[1:], len(kept))
        return pd.concat([docs, pd.DataFrame({
            "slice": self.number, "place": -1, "doc_id": pd.array([None] * len(cuts), "Int64"),
            "n": pd.array([None] * len(cuts), "Int64"), "digest": None, "fragment": fragment[cuts],
            "rest": [rest[a:b].tobytes() for a, b in zip(cuts, ends)],
            "owner": [place[a:b].tobytes() for a, b in zip(cuts, ends)], "shared": 0,
        })])


def _scan(fragments: int, words: int, threshold: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        packed = _Slice(number, fragments, threshold)
        for batch in batches:
            known = batch["_id"].notna()
            for doc_id, has, text in zip(batch["_id"], known, batch["_text"]):
                raw = text.encode()
                packed.add(int(doc_id) if has else None, len(raw), shingle_set(raw, words))
                if packed.size >= SLICE_BYTES or len(packed.docs) >= SLICE_DOCS:
                    yield packed.rows()
                    number += 1
                    packed = _Slice(number, fragments, threshold)
        if packed.docs:
            yield packed.rows()
        _WORDS.clear()
        release_memory()

    return run


def _shared_in_fragment(group: pd.DataFrame) -> pd.DataFrame:
    """How many of each document's shingles occur in several slices, for one hash range."""
    parts = [np.frombuffer(x, np.uint32) for x in group["rest"]]
    rest = np.concatenate(parts)
    place = np.concatenate([np.frombuffer(x, np.uint16) for x in group["owner"]])
    part = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    order = np.argsort(rest, kind="stable")
    same = np.diff(rest[order]) == 0
    shared = np.zeros(len(rest), bool)
    shared[order] = np.append(False, same) | np.append(same, False)
    shared &= place != SHARED
    docs, counts = np.unique(part[shared] << 16 | place[shared], return_counts=True)
    slices = group["slice"].to_numpy()
    return pd.DataFrame({"slice": slices[docs >> 16], "place": (docs & 0xFFFF).astype(np.int32), "elsewhere": counts})


def _classes(df: DataFrame, words: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, n, digest) of all rows, and one row per distinct non-empty set: rep (its smallest id), n, digest,
    found (shared shingles among its smallest ones)."""
    size = df.agg(F.sum(F.octet_length("_text").cast("bigint"))).first()[0] or 0
    fragments = max(LEAST_FRAGMENTS, -(-size // FRAGMENT_BYTES))
    packed = staged(df.mapInPandas(_scan(fragments, words, threshold), (
        "slice bigint, place int, doc_id bigint, n bigint, digest binary, fragment int, rest binary, owner binary, "
        "shared bigint")), "slices")
    elsewhere = packed.filter(F.col("fragment") >= 0).select("fragment", "slice", "rest", "owner").groupBy(
        "fragment").applyInPandas(_shared_in_fragment, "slice bigint, place int, elsewhere bigint")
    counted = elsewhere.groupBy("slice", "place").agg(F.sum("elsewhere").alias("elsewhere"))
    docs = packed.filter(F.col("fragment") < 0).select("slice", "place", "doc_id", "n", "digest", "shared")
    docs = staged(docs.join(counted, ["slice", "place"], "left").select(
        "doc_id", "n", "digest", (F.col("shared") + F.coalesce("elsewhere", F.lit(0))).alias("found")), "docs")
    groups = docs.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("n", "digest").agg(
        F.min("doc_id").alias("rep"), F.max("found").alias("found"))
    return docs, staged(groups, "classes")


def _at_least(n: Column, threshold: int) -> Column:
    return F.floor((n * threshold + 99) / 100).cast("bigint")


def _ordered_sets(df: DataFrame, groups: DataFrame, words: int, threshold: int) -> tuple[DataFrame, list[int]]:
    """(id, n, keys, typical) for the classes that may have a partner, and the cuts between the fragments of the order.

    A key is a shingle's place in the global order: how many classes hold it, then 48 bits of its hash. ``keys`` has those
    that several classes hold, in order; the others come before them and match nothing. ``typical`` is the mean logarithm of
    the counts over the whole set.
    """
    needed = F.greatest(F.lit(1), F.floor(_at_least(F.col("n"), threshold) / 5))
    likely = groups.filter(F.col("found") >= needed).groupBy("rep").agg(F.min("digest").alias("_digest"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start:start + 500]
                found = [shingle_set(text.encode(), words) for text in part["_text"]]
                right = [xxhash.xxh3_128_digest(f.tobytes()) == d for f, d in zip(found, part["_digest"])]
                rows = [(i, len(f), f.view(np.int64)) for i, f, r in zip(part["_id"], found, right) if r]
                if rows:
                    yield pd.DataFrame(rows, columns=["id", "n", "hashes"])
        _WORDS.clear()
        release_memory()

    again = df.join(likely, F.col("_id") == F.col("rep")).select("_id", "_text", "_digest")
    sets = staged(again.mapInPandas(run, "id bigint, n bigint, hashes array<bigint>"), "sets")
    rows = sets.select("id", "n", F.explode("hashes").alias("hash"))
    counts = staged(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > 1), "held")
    key = F.shiftleft(F.least("held", F.lit(32_767)), 48).bitwiseOR(F.shiftrightunsigned("hash", 16))
    keyed = rows.join(counts, "hash").select("id", "n", key.alias("key"), "held")
    ordered = staged(keyed.groupBy("id").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_set("key")).alias("keys"), 
        (F.sum(F.log("held")) / F.first("n")).alias("typical")), "order")
    steps = [k / FRAGMENTS for k in range(1, FRAGMENTS)]
    cuts = counts.agg(F.percentile_approx(key, steps)).first()[0] or []
    return ordered, [int(c) for c in cuts]


def _segments(sets: DataFrame, cuts: list[int]) -> DataFrame:
    """(id, n, fragment, part): the keys of a set that lie in each fragment of the order."""
    bounds = [None, *cuts, None]

    def part(low, high):
        def inside(k):
            return (F.lit(True) if low is None else k >= low) & (F.lit(True) if high is None else k < high)
        return F.filter("keys", inside)

    parts = F.array(*[part(low, high) for low, high in zip(bounds[:-1], bounds[1:])])
    cut = sets.select("id", "n", F.posexplode(parts).alias("fragment", "part"))
    return cut.filter(F.size("part") > 0)


def _verified(pairs: DataFrame, sets: DataFrame, cuts: list[int], least: int, threshold=None) -> DataFrame:
    """The pairs (a, b) with a Jaccard similarity of ``least`` % or more, how many shingles they share and whether they reach
    ``threshold``: overlaps are counted per fragment and summed."""
    segments = _segments(sets, cuts)
    one = segments.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("part").alias("part_b"))
    two = segments.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("part").alias("part_a"))
    met = pairs.join(one, "b").join(two, ["a", "fragment"])
    partial = met.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).alias("shared"))
    overlap = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return overlap.filter(100 * F.col("shared") >= least * union).select(
        "a", "b", "shared",
        (100 * F.col("shared") >= (threshold or least) * union).alias("linked"))


def _stars(sets: DataFrame, cuts: list[int], threshold: int) -> DataFrame:
    """Links (a, b, shared) between nodes b with an equal minimum hash and the most typical of them, a: the one whose other minimum
    hashes are shared most, then the one whose shingles are."""
    keys = [F.struct(F.lit(j).alias("j"), F.array_min(F.transform("keys", lambda k, j=j: F.xxhash64(k, F.lit(j)))).alias("h"))
            for j in range(STAR_KEYS)]
    rows = staged(sets.select("id", "typical", F.explode(F.array(*keys)).alias("key")).select("id", "typical", "key.*"), "keys")
    sizes = rows.groupBy("j", "h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    shared = staged(rows.join(staged(sizes, "sizes"), ["j", "h"]), "shared")
    score = shared.groupBy("id").agg(F.round(F.sum(F.log2("_n")), 6).alias("score"))
    scored = staged(shared.join(score, "id").drop("_n"), "scored")
    centres = scored.groupBy("j", "h").agg(F.max_by("id", F.struct("score", "typical", -F.col("id"))).alias("a"))
    pairs = scored.join(staged(centres, "centres"), ["j", "h"]).select("a", F.col("id").alias("b"))
    return staged(_verified(pairs.filter(F.col("a") != F.col("b")).distinct(), sets, cuts, threshold).drop("linked"), "links")


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with the component of their id, or the id itself, as ``c``."""
    known = parts.select(F.col("node").alias("id"), F.col("component").alias("_c"))
    return rows.join(known, "id", "left").withColumn("c", F.coalesce("_c", "id")).drop("_c")


def _members(sets: DataFrame, stars: DataFrame, parts: DataFrame) -> DataFrame:
    """Nodes with their component ``c``, the centre of the largest star they are in (or themselves), how many keys they hold
    and how many of these the centre holds too."""
    own = stars.select("a", F.col("a").alias("b"), F.lit(None).cast("bigint").alias("shared")).distinct()
    sizes = stars.groupBy("a").agg(F.count(F.lit(1)).alias("_size"))
    centres = stars.select("a", "b", "shared").unionByName(own).join(sizes, "a").groupBy(F.col("b").alias("id")).agg(
        F.max_by(F.struct("a", "shared"), F.struct("_size", -F.col("a"))).alias("_star"))
    return staged(_placed(sets.select("id", "n", "keys"), parts).join(centres, "id", "left").select(
        "id", "n", "keys", "c", F.size("keys").alias("held"), F.coalesce("_star.a", "id").alias("centre"),
        F.coalesce("_star.shared", F.size("keys")).alias("in_centre")), "members")


def _mixed_prefixes(members: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """The keys in prefixes of the global order that several components hold: (key, c, centre, ...) for each node's, with the
    component that has most members there as ``major``; and per key and star how many members hold it, and their bounds."""
    prefix = F.col("n") - _at_least(F.col("n"), threshold) + 1 - (F.col("n") - F.size("keys"))
    rows = members.filter(prefix > 0).select("id", "n", "c", "centre", "held", F.posexplode(
        F.slice("keys", F.lit(1), prefix.cast("int"))).alias("place", "key"))
    # Of keys that others hold, too, how many a set has from this one on.
    rows = staged(rows.select("id", "n", "c", "centre", "key", (F.col("held") - F.col("place")).alias("left")), "prefixes")
    held = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("members"))
    mixed = held.groupBy("key").agg(F.max_by("c", F.struct("members", "c")).alias("major"), F.count(F.lit(1)).alias("parts"))
    mixed = staged(mixed.filter(F.col("parts") > 1).drop("parts"), "mixed")
    rows = staged(rows.join(mixed, "key"), "mixed_rows")
    groups = rows.groupBy("key", "c", "centre").agg(
        F.count(F.lit(1)).alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("left").alias("left"))
    return rows, staged(groups, "groups")


def _met(rows: DataFrame, groups: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of a node and the centre of another component's star, some member of which may be similar to the node."""
    x, y = rows.alias("x"), groups.alias("y")
    # Similar sets meet at the first key they share: all they share is there or after it.
    reach = F.least("x.left", "y.left")
    fits = (100 * F.col("x.n") >= threshold * F.col("y.least_n")) & (100 * F.col("y.most_n") >= threshold * F.col("x.n")) & (
        (100 + threshold) * reach >= threshold * (F.col("x.n") + F.col("y.least_n")))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & fits)
    return met.select(F.col("x.id").alias("a"), F.col("y.centre").alias("b")).distinct()


def _united(parts: DataFrame, links: DataFrame) -> DataFrame:
    return components(parts.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(links.select("a", "b")))


def _joined_stars(sets: DataFrame, stars: DataFrame, parts: DataFrame, cuts: list[int],
                  threshold: int) -> tuple[DataFrame, DataFrame]:
    """``stars`` and components with the nodes added that link with the centre of the largest star at one of their keys."""
    rows, groups = _mixed_prefixes(_members(sets, stars, parts), threshold)
    largest = groups.groupBy("key").agg(F.max_by(F.struct(*[c for c in groups.columns if c != "key"]),
                                                 F.struct("members", "centre")).alias("_g")).select("key", "_g.*")
    found = _verified(_met(rows, largest, threshold), sets, cuts, threshold).select(
        F.col("b").alias("a"), F.col("a").alias("b"), "shared")
    found = staged(found, "joined")
    return staged(stars.unionByName(found).distinct(), "stars"), _united(parts, found)


def _cross_links(sets: DataFrame, stars: DataFrame, parts: DataFrame, cuts: list[int], threshold: int) -> DataFrame:
    """Links (a, b) between the components ``parts``, at least one for each two that a link joins.

    Such a pair shares a key in both prefixes of the order, and where it does, one of the two is not in the component with
    most members there. That node is compared with the centre of the other's star instead of all its members: Jaccard
    distances obey the triangle inequality, so a centre is at most twice as far as a link allows. A node that links with the
    centre is joined with the star by that. Of the stars that pass otherwise, members are compared themselves if they can be
    similar: what node and member share is at most the smaller of what each shares with the centre, and the smaller of what
    each holds besides.
    """
    members = _members(sets, stars, parts)
    rows, groups = _mixed_prefixes(members, threshold)
    near = _met(rows.filter(F.col("c") != F.col("major")), groups, threshold)
    # Below a threshold of one half centres say nothing, and all members are compared.
    near = staged(_verified(near, sets, cuts, max(1, 2 * threshold - 100), threshold) if threshold > 50 else near.select(
        "a", "b", F.lit(None).cast("bigint").alias("shared"), F.lit(False).alias("linked")), "near")
    direct = near.filter("linked").select("a", "b")
    named = staged(_united(parts, direct), "named")
    for end in ("a", "b"):
        near = near.join(named.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}")), end, "left")
    far = near.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b", "shared").join(
        members.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("held").alias("held_a")), "a")
    others = members.select(F.col("centre").alias("b"), F.col("id").alias("_member"), "n", "held", "in_centre")
    most = F.least("shared", "in_centre") + F.least(F.col("held_a") - F.col("shared"), F.col("held") - F.col("in_centre"))
    similar = F.coalesce((100 + threshold) * most >= threshold * (F.col("n") + F.col("n_a")), F.lit(True))
    pairs = staged(far, "far").join(others, "b").filter(similar & (F.col("a") != F.col("_member"))).select(
        F.least("a", "_member").alias("a"), F.greatest("a", "_member").alias("b")).distinct()
    return staged(_verified(pairs, sets, cuts, threshold).select("a", "b").unionByName(direct), "links")


def similar_classes(df: DataFrame, threshold=80, words=5, id_column="doc_id", text="text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Two rows link when threshold % of the union of their sets of ``words``-word shingles is shared; shorter texts are one
    shingle. component_id is the smallest id reachable by links, the row's own included. Texts without words, null texts and
    rows without an id link with nothing (component_id is the row's id). Repeated rows are in one class. Ids stand for one
    text: if an id has several, one of them takes part in links. Other columns are not read. Ids are whole numbers.
    """
    rows = df.select(F.col(id_column).cast("bigint").alias("_id"), text_or_empty(text).alias("_text"))
    docs, groups = _classes(rows, words, threshold)
    sets, cuts = _ordered_sets(rows, groups, words, threshold)
    stars = _stars(sets, cuts, threshold)
    parts = components(stars)
    stars, parts = _joined_stars(sets, stars, parts, cuts, threshold)
    more = _cross_links(sets, stars, parts, cuts, threshold)
    if not more.isEmpty():
        parts = _united(parts, more)
    named = _placed(groups.select(F.col("rep").alias("id"), "n", "digest"), parts).select("n", "digest", F.col("c").alias("_c"))
    joined = docs.join(staged(named, "named"), ["n", "digest"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(df: DataFrame, id_column="doc_id", **options) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its class, each once; rows without an id stay."""
    classes = staged(similar_classes(df, id_column=id_column, **options), "similar")
    kept = staged(classes.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("times")), "kept")
    once = kept.filter(F.col("times") == 1).select(F.col("doc_id").alias("_kept"))
    out = df.join(once, F.col(id_column) == F.col("_kept"), "left_semi")
    if not kept.filter(F.col("times") > 1).isEmpty():
        repeated = kept.filter(F.col("times") > 1).select(F.col("doc_id").alias("_kept"))
        again = df.join(repeated, F.col(id_column) == F.col("_kept"), "left_semi")
        out = out.unionByName(again.dropDuplicates([id_column]))
    return out.unionByName(df.filter(F.col(id_column).isNull()))
