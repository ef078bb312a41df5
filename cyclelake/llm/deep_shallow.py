"""Deep-shallow sorting of suffixes that are compared up to a limit.

Shallow: multikey quicksort. A character is eight bytes; all groups of suffixes that tie so far are partitioned in three
around a pivot of their own at once, those equal to the pivot go on to the next character. Deep: groups that still tie after
the shallow depth share a long prefix; blind tries put each of their suffixes in place by one comparison.
"""

from __future__ import annotations

import numpy as np

CHARACTER = 8


def characters(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every place of the text as one big-endian number; behind the end are zeros."""
    padded = np.append(text, np.zeros(CHARACTER, np.uint8)).tobytes()
    out = np.empty(len(text), np.uint64)
    for j in range(CHARACTER):
        part = np.frombuffer(padded, ">u8", count=(len(text) - j + CHARACTER - 1) // CHARACTER, offset=j)
        out[j::CHARACTER] = part
    return out


class _Blind:
    """A Patricia trie that keeps branching depths and characters only; leaves are lists of equal suffixes."""

    def __init__(self, first: bytes, suffix: int):
        self.strings, self.root = [first], 0
        self.leaves = {0: [suffix]}
        self.branch = {}       # inner node (negative) -> (depth, {character: node})

    def add(self, string: bytes, suffix: int) -> None:
        node, path = self.root, []
        while node < 0:
            path.append(node)
            depth, children = self.branch[node]
            node = children.get(string[depth], next(iter(children.values())))
        other = self.strings[node]
        if other == string:
            self.leaves[node].append(suffix)
            return
        same = next(i for i, (x, y) in enumerate(zip(other, string)) if x != y)
        leaf = len(self.strings)
        self.strings.append(string)
        self.leaves[leaf] = [suffix]
        above = [n for n in path if self.branch[n][0] <= same]
        if above and self.branch[above[-1]][0] == same:
            self.branch[above[-1]][1][string[same]] = leaf
            return
        inner = -1 - len(self.branch)
        below = path[len(above)] if len(above) < len(path) else node
        self.branch[inner] = (same, {other[same]: below, string[same]: leaf})
        if above:
            self.branch[above[-1]][1][string[self.branch[above[-1]][0]]] = inner
        else:
            self.root = inner

    def in_order(self):
        left = [self.root]
        while left:
            node = left.pop()
            if node >= 0:
                yield self.leaves[node]
            else:
                children = self.branch[node][1]
                left.extend(children[c] for c in sorted(children, reverse=True))


def _deep(words: np.ndarray, raw: bytes, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int, limit: int,
          new: np.ndarray) -> None:
    """Orders each group (places ``starts`` to ``starts`` + ``sizes`` of ``order``), whose suffixes agree up to ``depth``."""
    place = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    suffix, first = order[place], np.repeat(order[starts], sizes)
    differs = np.zeros(len(place), bool)
    for at in [*range(depth, limit - CHARACTER, CHARACTER), limit - CHARACTER]:     # the last character may overlap
        differs |= words[suffix + at] != words[first + at]
    mixed = np.bincount(np.repeat(np.arange(len(sizes)), sizes), differs, len(sizes)) > 0
    for start, size in zip(starts[mixed].tolist(), sizes[mixed].tolist()):
        own = order[start:start + size].tolist()
        trie = _Blind(raw[own[0] + depth:own[0] + limit], own[0])
        for s in own[1:]:
            trie.add(raw[s + depth:s + limit], s)
        at = start
        for equal in trie.in_order():
            order[at:at + len(equal)] = equal
            new[at:at + len(equal)] = False
            new[at] = True
            at += len(equal)


def sort_suffixes(text: np.ndarray, suffixes: np.ndarray, group: np.ndarray, limit: int, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes in the order of (group, their first ``limit`` bytes), and which of them differs from the one before
    it. Every suffix has ``limit`` bytes of text; ``shallow`` is a multiple of eight, at most ``limit``; ``limit`` is at least eight."""
    words, raw = characters(text), text.tobytes()
    by = np.argsort(group, kind="stable")
    order, group = suffixes[by], group[by]
    new = np.append(True, group[1:] != group[:-1])[:len(order)]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(order)))
    depths = np.zeros(len(starts), np.int64)
    tied = []
    while True:
        done = (depths >= shallow) & (sizes > 1)
        tied.append((starts[done], sizes[done]))
        going = (sizes > 1) & ~done
        starts, sizes, depths = starts[going], sizes[going], depths[going]
        if not len(starts):
            break
        ends = np.cumsum(sizes)
        number = np.repeat(np.arange(len(starts)), sizes)
        place = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        suffix = order[place]
        word = words[suffix + depths[number]]
        # The median of three words of each group.
        a, b, c = word[ends - sizes], word[ends - sizes + sizes // 2], word[ends - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[number]
        side = number * 3 + (word > pivot) + (word >= pivot)
        # Counting: where each third of a group begins, and the rank of each suffix inside its third.
        ranked = np.argsort(side, kind="stable")
        side = side[ranked]
        order[place] = suffix[ranked]
        first = np.append(True, side[1:] != side[:-1])
        at = np.flatnonzero(first)
        new[place[at]] = True
        starts, sizes = place[at], np.diff(np.append(at, len(side)))
        depths = depths[side[at] // 3] + CHARACTER * (side[at] % 3 == 1)
    starts, sizes = (np.concatenate(x) for x in zip(*tied))
    if shallow < limit and len(starts):
        _deep(words, raw, order, starts, sizes, shallow, limit, new)
    return order, new
