"""An adaptive radix tree over byte keys: nodes grow from 4 to 16, 48 and 256 children, and runs of single children are one node.

A helper for one task's slice of keys; `prefix_trie` splits the keys over tasks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Few:
    """Up to `most` children, by sorted bytes: the layouts for 4 and for 16."""

    __slots__ = ("most", "bytes", "kids")

    def __init__(self, most: int):
        self.most, self.bytes, self.kids = most, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: Node) -> bool:
        """False if there is no room for another byte."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
        elif len(self.bytes) == self.most:
            return False
        else:
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.kids, strict=True)


class Indexed:
    """Up to 48 children: a byte's entry tells its place among them."""

    __slots__ = ("places", "kids")
    NONE = 255

    def __init__(self):
        self.places, self.kids = bytearray([self.NONE]) * 256, []

    def get(self, byte: int) -> Node | None:
        at = self.places[byte]
        return self.kids[at] if at != self.NONE else None

    def put(self, byte: int, kid: Node) -> bool:
        at = self.places[byte]
        if at != self.NONE:
            self.kids[at] = kid
        elif len(self.kids) == 48:
            return False
        else:
            self.places[byte] = len(self.kids)
            self.kids.append(kid)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.kids[at]) for b, at in enumerate(self.places) if at != self.NONE)


class Whole:
    """A place for every byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> bool:
        self.kids[byte] = kid
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


def _larger(layout: Few | Indexed) -> Few | Indexed | Whole:
    grown = Whole() if isinstance(layout, Indexed) else Few(16) if layout.most == 4 else Indexed()
    for byte, kid in layout.items():
        grown.put(byte, kid)
    return grown


class Node:
    """The bytes after the one that leads here, the value of the key that ends here, and the children; leaves have no layout."""

    __slots__ = ("run", "value", "layout")

    def __init__(self, run: bytes, value: object = None):
        self.run, self.value, self.layout = run, value, None

    def get(self, byte: int) -> Node | None:
        return self.layout.get(byte) if self.layout else None

    def put(self, byte: int, kid: Node) -> None:
        if self.layout is None:
            self.layout = Few(4)
        while not self.layout.put(byte, kid):
            self.layout = _larger(self.layout)

    def items(self) -> Iterator[tuple[int, Node]]:
        return self.layout.items() if self.layout else iter(())


def shared(a: bytes | bytearray, b: bytes, at: int) -> int:
    """Number of first bytes that `a` shares with `b` from place `at`."""
    a = bytes(a)
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


class Tree:
    """Keys with values. `add` gives the slot's node, whose value the caller sets or merges."""

    def __init__(self):
        self.root: Node | None = None

    def add(self, key: bytes) -> Node:
        if self.root is None:
            self.root = Node(key)
            return self.root
        node, at, above, byte = self.root, 0, None, 0
        while True:
            same = shared(node.run, key, at)
            if same < len(node.run):
                upper = Node(node.run[:same])
                upper.put(node.run[same], node)
                node.run = node.run[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.put(byte, upper)
                node = upper
            at += same
            if at == len(key):
                return node
            above, byte = node, key[at]
            at += 1
            kid = node.get(byte)
            if kid is None:
                kid = Node(key[at:])
                node.put(byte, kid)
                return kid
            node = kid
