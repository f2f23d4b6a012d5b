"""Sorting of byte strings with long common prefixes: multikey quicksort to a shallow depth, then blind tries.

The quicksort looks at a few bytes at a time and stops at the shallow depth. What is still together there has a long common prefix,
and is ordered by a blind trie: a string is led down by the branching bytes alone, compared once with the leaf that it ends at, and
put in where the two part; common prefixes are never compared byte by byte again.
"""

from __future__ import annotations

SHALLOW, STEP = 16, 4
END = -1


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Node:
    __slots__ = ("at", "children")

    def __init__(self, at: int, children: dict):
        self.at, self.children = at, children


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else END


def blind_trie(strings: list[bytes], group: list[int]) -> list[tuple[int, int]]:
    """``group`` (places in ``strings``, all different strings) in order, each with its common prefix with the one before it (0 for the first)."""
    root: _Node | int = group[0]
    for new in group[1:]:
        s, node = strings[new], root
        while isinstance(node, _Node):
            node = node.children.get(_byte(s, node.at)) if _byte(s, node.at) in node.children else next(iter(node.children.values()))
        lcp = common_prefix(s, strings[node])
        above, node = None, root
        while isinstance(node, _Node) and node.at < lcp:
            above, node = node, node.children[_byte(s, node.at)]
        if isinstance(node, _Node) and node.at == lcp:
            node.children[_byte(s, lcp)] = new
            continue
        leaf = node
        while isinstance(leaf, _Node):
            leaf = next(iter(leaf.children.values()))
        fork = _Node(lcp, {_byte(strings[leaf], lcp): node, _byte(s, lcp): new})
        if above is None:
            root = fork
        else:
            above.children[_byte(s, above.at)] = fork
    out: list[tuple[int, int]] = []
    stack: list[tuple] = [(root, 0)]  # a subtree, and the common prefix of its first leaf with the leaf before it
    while stack:
        node, lcp = stack.pop()
        if isinstance(node, _Node):
            ranked = sorted(node.children)
            stack += [(node.children[c], node.at if k else lcp) for k, c in reversed(list(enumerate(ranked)))]
        else:
            out.append((node, lcp))
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before it (0 for the first). Equal strings stay together."""
    same: dict[bytes, list[int]] = {}
    for k, s in enumerate(strings):
        same.setdefault(s, []).append(k)
    ranked: list[int] = []
    lcps: list[int] = []

    def put(group: list[tuple[int, int]]) -> None:
        for first, lcp in group:
            s = strings[first]
            if lcp < 0:
                lcp = common_prefix(strings[ranked[-1]], s) if ranked else 0
            for k, place in enumerate(same[s]):
                ranked.append(place)
                lcps.append(len(s) if k else lcp)

    stack: list[tuple[list[int], int]] = [([places[0] for places in same.values()], 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) <= 1:
            put([(g, -1) for g in group])
        elif depth >= shallow:
            ordered = blind_trie(strings, group)
            put([(ordered[0][0], -1), *ordered[1:]])
        else:
            pivot = strings[group[len(group) // 2]][depth:depth + STEP]
            parts: tuple[list[int], list[int], list[int]] = [], [], []
            for g in group:
                key = strings[g][depth:depth + STEP]
                parts[(key > pivot) + (key >= pivot)].append(g)
            # A key shorter than the step has ended: there is one such string in the equal part, and it comes first.
            stack += [(parts[2], depth), (parts[1], depth + STEP if len(pivot) == STEP else shallow), (parts[0], depth)]
    return ranked, lcps
