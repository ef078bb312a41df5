import hashlib
import random
import zlib

import pytest

from cyclelake.llm.conversation_trie import prefix_trie
from cyclelake.llm.radix_tree import RadixTree, _Direct, _Indexed, _Sorted

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth int"


def plain(rows):
    """The trie by definition, on all prefixes of all rebuilt conversations."""
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda t: hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()
    for turns in said.values():
        turns.sort(key=lambda t: (*t[:2], key(t)))
    whole = {}
    for conv, turns in said.items():
        h = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = [t[2:] for t in said.get(conv - conv % 5, [])[:h] + turns[h:]]
    nodes = {}
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for path, members in nodes.items():
        below = [(p, m) for p, m in nodes.items() if p[:len(path)] == path]
        ends = ",".join(str(c) for c in sorted(m for m in members if len(whole[m]) == len(path)))
        childless = [p for p, _ in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q, _ in below)]
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p, _ in below), len(childless),
                    sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in below if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_rows(seed, convs, longest, kinds=3):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(convs * 2), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, None, 3]), rng.choice(["user", "a", None]),
                         rng.choice([None, "", "ü" * 3, *[f"t{k}" for k in range(kinds)]])))
    return rows + rng.sample(rows, 5) + [(None, 1, "user", "nobody")]


@pytest.mark.parametrize("seed, longest, segment", [(1, 4, 256), (2, 14, 256), (3, 14, 2), (4, 25, 5)])
def test_equals_definition(spark, seed, longest, segment):
    rows = some_rows(seed, 25, longest)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    assert shown(prefix_trie(df, segment)) == plain(rows)


def test_copies_turnless_and_empty(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 400, 5) for t in range(9)] + [(1, 0, "user", "only")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert shown(prefix_trie(df)) == plain(rows)
    assert prefix_trie(df.limit(0)).collect() == []


def test_tree_grows_splits_and_finds():
    rng = random.Random(5)
    keys = [bytes([rng.randrange(256) for _ in range(rng.choice([0, 2, 4]))]) for _ in range(3000)]
    keys += [b"\x01\x02" + k for k in keys[:500]]
    tree = RadixTree()
    for k in keys:
        node = tree.slot(k)
        node.value = (node.value or 0) + 1
    found, path = {}, {}
    for node, parent, byte in tree.parents_first():
        path[id(node)] = (path[id(parent)] + bytes([byte]) if parent else b"") + node.prefix
        if node.value is not None:
            found[path[id(node)]] = node.value
    assert found == {k: keys.count(k) for k in set(keys)}
    layouts = {type(n.children) for n, _, _ in tree.parents_first() if n.children is not None}
    assert layouts == {_Sorted, _Indexed, _Direct}
    assert {n.children.room for n, _, _ in tree.parents_first() if n.children is not None} == {4, 16, 48, 256}
