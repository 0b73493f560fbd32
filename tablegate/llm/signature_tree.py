"""Connected documents of one block: a signature tree walked against itself.

Every node of the tree holds the union of its documents' token bitmaps and the range of their sizes. From two nodes
follows how large an overlap of a document of one with a document of the other can be at most; pairs of nodes that
cannot reach the wanted similarity are left, and so are pairs whose documents are known to be connected already.
What remains at the leaves is compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FAN = 8


def enough(overlap: int, left: int, right: int, percent: int) -> bool:
    """Whether a Jaccard similarity is at least ``percent`` of 100."""
    return 100 * overlap >= percent * (left + right - overlap)


class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


@dataclass(slots=True)
class Node:
    bits: int
    least: int
    most: int
    #: The most tokens of a document that share a bit with another of its tokens.
    spare: int
    member: int
    children: list[Node] = field(default_factory=list)
    whole: bool = False

    def root(self, groups: Groups) -> int | None:
        """The group of all documents below, if they are known to be in one."""
        if not self.whole:
            roots = {c.root(groups) for c in self.children}
            self.whole = len(roots) == 1 and None not in roots
        return groups.find(self.member) if self.whole else None


def _bitmap(tokens: np.ndarray, width: int) -> int:
    mark = np.zeros(width, bool)
    mark[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return int.from_bytes(np.packbits(mark).tobytes(), "big")


def tree(sets: list[np.ndarray], members: list[int], width: int) -> Node:
    """A tree over sorted token arrays; documents with the same smallest token and like sizes are neighbours."""
    level = []
    for i in sorted(members, key=lambda i: (int(sets[i][0]), len(sets[i]))):
        bits = _bitmap(sets[i], width)
        level.append(Node(bits, len(sets[i]), len(sets[i]), len(sets[i]) - bits.bit_count(), i, whole=True))
    while len(level) > 1:
        above = []
        for k in range(0, len(level), FAN):
            part = level[k : k + FAN]
            bits = 0
            for node in part:
                bits |= node.bits
            least, most = min(n.least for n in part), max(n.most for n in part)
            above.append(Node(bits, least, most, max(n.spare for n in part), part[0].member, part))
        level = above
    return level[0]


def may_link(x: Node, y: Node, percent: int) -> bool:
    """Whether two documents below the nodes can be similar enough, by the largest overlap that is possible."""
    if 100 * x.most < percent * y.least or 100 * y.most < percent * x.least:
        return False
    most = min((x.bits & y.bits).bit_count() + min(x.spare, y.spare), x.most, y.most)
    return enough(most, max(most, x.least), max(most, y.least), percent)


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x))


def connect(sets: list[np.ndarray], x: Node, y: Node, groups: Groups, percent: int) -> None:
    """Join the groups of all documents below ``x`` that are similar enough to a document below ``y``."""
    todo = [(x, y)]
    while todo:
        x, y = todo.pop()
        left = x.root(groups)
        if left is not None and left == y.root(groups):
            continue
        if x is y:
            parts = x.children
            todo += [(a, b) for i, a in enumerate(parts) for b in parts[i + 1 :]]
            todo += [(a, a) for a in parts if a.children]
            continue
        if not may_link(x, y, percent):
            continue
        if not x.children and not y.children:
            a, b = sets[x.member], sets[y.member]
            if enough(_overlap(a, b), len(a), len(b), percent):
                groups.join(x.member, y.member)
        elif not y.children or (x.children and x.bits.bit_count() >= y.bits.bit_count()):
            todo += [(c, y) for c in x.children]
        else:
            todo += [(x, c) for c in y.children]


def width_for(sets: list[np.ndarray]) -> int:
    """Bits of a bitmap: eight for each token of the largest set, as a power of two."""
    return 1 << max(9, (8 * max((len(s) for s in sets), default=1) - 1).bit_length())
