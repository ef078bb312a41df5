"""An adaptive radix tree over byte strings: path compression and four node layouts that grow with their children."""

from __future__ import annotations

from collections.abc import Iterator

WIDTHS = (4, 16, 48, 256)


class _Sorted:
    """Up to 4 or 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("keys", "nodes", "room")

    def __init__(self, room: int):
        self.keys, self.nodes, self.room = bytearray(), [], room

    def get(self, byte: int):
        at = self.keys.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node) -> None:
        at = self.keys.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return
        at = sum(k < byte for k in self.keys)
        self.keys.insert(at, byte)
        self.nodes.insert(at, node)

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def items(self) -> Iterator[tuple]:
        return zip(self.keys, self.nodes)

    def grown(self):
        out = _Sorted(WIDTHS[1]) if self.room == WIDTHS[0] else _Indexed()
        for byte, node in self.items():
            out.put(byte, node)
        return out


class _Indexed:
    """Up to 48 children: a table of 256 places into them."""

    __slots__ = ("places", "nodes")
    room = WIDTHS[2]

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node) -> None:
        at = self.places[byte]
        if at:
            self.nodes[at - 1] = node
        else:
            self.nodes.append(node)
            self.places[byte] = len(self.nodes)

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def items(self) -> Iterator[tuple]:
        return ((byte, self.nodes[at - 1]) for byte, at in enumerate(self.places) if at)

    def grown(self):
        out = _Direct()
        for byte, node in self.items():
            out.put(byte, node)
        return out


class _Direct:
    """Up to 256 children, each at its byte."""

    __slots__ = ("nodes",)
    room = WIDTHS[3]

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> None:
        self.nodes[byte] = node

    def full(self) -> bool:
        return False

    def items(self) -> Iterator[tuple]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


class Node:
    """``prefix``: the bytes that all keys below share after the byte that leads here. ``value``: of the key that ends here."""

    __slots__ = ("prefix", "children", "value")

    def __init__(self, prefix: bytes):
        self.prefix, self.children, self.value = prefix, None, None

    def child(self, byte: int):
        return self.children.get(byte) if self.children is not None else None

    def attach(self, byte: int, node: Node) -> None:
        if self.children is None:
            self.children = _Sorted(WIDTHS[0])
        elif self.children.full() and self.children.get(byte) is None:
            self.children = self.children.grown()
        self.children.put(byte, node)

    def items(self):
        return self.children.items() if self.children is not None else ()


def _common(a: bytes, key: bytes, start: int) -> int:
    """How many bytes of ``a`` the key repeats from ``start`` on."""
    if key.startswith(a, start):
        return len(a)
    low, high = 0, min(len(a), len(key) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(a[:middle], start):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def slot(self, key: bytes) -> Node:
        """The node where the key ends; made where it is not there yet."""
        node, at = self.root, 0
        while True:
            same = _common(node.prefix, key, at)
            if same < len(node.prefix):
                # The key leaves inside the compressed path: what is above becomes a node of its own.
                lower = Node(node.prefix[same + 1:])
                lower.children, lower.value = node.children, node.value
                byte, node.prefix, node.children, node.value = node.prefix[same], node.prefix[:same], None, None
                node.attach(byte, lower)
            at += same
            if at == len(key):
                return node
            following = node.child(key[at])
            if following is None:
                following = Node(key[at + 1:])
                node.attach(key[at], following)
                return following
            node, at = following, at + 1

    def parents_first(self) -> list[tuple[Node, Node | None, int]]:
        """(node, its parent, the byte between them), every parent before its children."""
        out, left = [], [(self.root, None, -1)]
        while left:
            entry = left.pop()
            out.append(entry)
            left.extend((child, entry[0], byte) for byte, child in entry[0].items())
        return out
