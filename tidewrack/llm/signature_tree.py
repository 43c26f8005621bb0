"""A signature tree over sets, and the dual traversal that finds similar pairs.

A set's signature is a bitmap with a bit for each hashed token (a Python
integer).  Its width is a power of two that grows with the set; of very large
sets only the first WINDOW bits are kept, so a signature's size is bounded.  A
node of the tree holds the OR of its members' bitmaps, the range of their sizes,
and the largest number of tokens that a member has beyond its bits.  No member
of P shares more than popcount(P.bits & Q.bits) + min(P.spare, Q.spare) tokens
with a member of Q, nor more than the smaller size; pairs of nodes of which that
is too little for the threshold are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

FANOUT = 8
WINDOW = 2048


def width_of(n: int) -> int:
    """Width of the bitmap of n tokens: four to eight places for each, 64 at least."""
    return max(64, 4 << (n - 1).bit_length())


def fold(bits: int | None, width: int, to: int) -> int | None:
    """A bitmap brought to a smaller width; None, for not known, where only its first bits were kept."""
    if width > to and width > WINDOW:
        return None
    while bits is not None and width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


class Node:
    __slots__ = ("low", "high", "bits", "width", "spare", "children", "item", "classes")

    def __init__(self, low, high, bits, width, spare, children, item, classes):
        self.low, self.high, self.bits, self.width, self.spare = low, high, bits, width, spare
        self.children, self.item, self.classes = children, item, classes


def leaf(item: int, size: int, bits: int, width: int, cls: int) -> Node:
    return Node(size, size, bits, width, size - bits.bit_count(), (), item, cls)


def build(leaves: Sequence[Node]) -> Node:
    """Leaves in order of size and bits, joined by FANOUT, level by level."""
    level = sorted(leaves, key=lambda x: (x.low, (x.bits or 0) & 0xFFFFFFFF))
    while len(level) > 1:
        parents = []
        for i in range(0, len(level), FANOUT):
            part = level[i : i + FANOUT]
            width = min(x.width for x in part)
            bits, spare = 0, 0
            for x in part:
                folded = fold(x.bits, x.width, width)
                if folded is None or bits is None:
                    bits = None
                    continue
                bits |= folded
                # what folding adds to the tokens beyond the bits is known of single sets only
                spare = max(spare, x.spare if x.width == width else x.high - folded.bit_count() if x.item is not None else x.high)
            cls = part[0].classes if all(x.classes == part[0].classes for x in part) else None
            parents.append(Node(min(x.low for x in part), max(x.high for x in part), bits, width, spare, part, None, cls))
        level = parents
    return level[0]


def possible(p: Node, q: Node, percent: int) -> bool:
    """Whether members of p and q may have 100 * shared >= percent * united."""
    if p.high * 100 < percent * q.low or q.high * 100 < percent * p.low:
        return False
    need = percent * (p.low + q.low)
    if need > (100 + percent) * min(p.high, q.high):
        return False
    a, b = p.bits, q.bits
    if p.width == q.width:
        spare = min(p.spare, q.spare)
    elif p.item is None or q.item is None:
        return True  # how many tokens folding puts beyond the bits is known of single sets only
    else:
        to = min(p.width, q.width)
        a, b = fold(a, p.width, to), fold(b, q.width, to)
        if a is not None and b is not None:
            spare = min(p.high - a.bit_count(), q.high - b.bit_count())
    return a is None or b is None or need <= (100 + percent) * ((a & b).bit_count() + spare)


def traverse(p: Node, q: Node, percent: int, visit: Callable[[int, int], None], apart: Callable[[Node, Node], bool]) -> None:
    """visit(a, b) for each pair of leaves, one of p and one of q, that may be similar.

    `apart(p, q)` tells whether a pair of nodes still needs a look; with p and q
    the same node, each pair within it is met once.
    """
    todo = [(p, q)]
    while todo:
        p, q = todo.pop()
        if not apart(p, q):
            continue
        if p is not q and not possible(p, q, percent):
            continue
        if p.item is not None and q.item is not None:
            if p is not q:
                visit(p.item, q.item)
        elif p is q:
            for i, a in enumerate(p.children):
                todo += [(a, b) for b in p.children[i:]]
        elif q.item is not None or (p.item is None and p.high - p.low >= q.high - q.low):
            todo += [(a, q) for a in p.children]
        else:
            todo += [(p, b) for b in q.children]
