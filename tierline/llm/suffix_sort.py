"""Deep-shallow sorting of byte strings, with their longest common prefixes.

Multikey quicksort orders the strings by eight bytes at a time down to a shallow
depth. Strings still equal there have long common prefixes, and a blind trie orders
them: it keeps only the places where its strings first differ, so a string descends
by looking at single bytes, is compared once with the leaf it reaches, and is hung in
where the two differ.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32  # bytes
SMALL = 12  # groups of so few are sorted by comparison


class _Node:
    __slots__ = ("children", "depth", "members")

    def __init__(self, depth: int):
        self.depth, self.children, self.members = depth, {}, None


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, ``known`` of which is known."""
    n = min(len(a), len(b))
    step = 32
    while known < n and a[known : known + step] == b[known : known + step]:
        known += step
    known = min(known, n)
    while known < n and a[known] == b[known]:
        known += 1
    return known


def blind_trie_order(strings: list[bytes], ids: list[int], depth: int) -> list[int]:
    """``ids`` ordered by their strings, whose first ``depth`` bytes are equal. The end of a string comes before any byte."""
    at = lambda s, i: s[i] if i < len(s) else -1

    def leaf(i: int) -> _Node:
        node = _Node(len(strings[i]) + 1)
        node.members = [i]
        return node

    root = leaf(ids[0])
    for i in ids[1:]:
        s, node = strings[i], root
        while node.members is None:  # blind: bytes between branching places are not looked at
            node = node.children.get(at(s, node.depth)) or next(iter(node.children.values()))
        other = strings[node.members[0]]
        if s == other:
            node.members.append(i)
            continue
        d = common_prefix(s, other, depth)
        parent, byte, node = None, 0, root
        while node.members is None and node.depth < d:
            parent, byte = node, at(s, node.depth)
            node = node.children[byte]
        if node.members is None and node.depth == d:
            node.children[at(s, d)] = leaf(i)
            continue
        fork = _Node(d)
        fork.children = {at(other, d): node, at(s, d): leaf(i)}
        if parent is None:
            root = fork
        else:
            parent.children[byte] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.members is not None:
            out += node.members
        else:
            stack += [node.children[c] for c in sorted(node.children, reverse=True)]
    return out


def _padded(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(s[:width].ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> np.ndarray:
    """The places of ``strings`` in ascending order."""
    if not strings:
        return np.empty(0, np.int64)
    keys = _padded(strings, shallow).view(">u8").astype(np.uint64)
    out: list[int] = []
    stack = [(np.arange(len(strings)), 0)]
    while stack:
        group, word = stack.pop()
        if len(group) <= SMALL:
            out += sorted(group.tolist(), key=strings.__getitem__)
            continue
        if word == keys.shape[1]:
            # Equal keys may hide ends of strings among zero bytes: only what all have is known equal.
            known = min(shallow, min(len(strings[i]) for i in group.tolist()))
            out += blind_trie_order(strings, group.tolist(), known)
            continue
        own = keys[group, word]
        pivot = np.sort(own[[0, len(own) // 2, -1]])[1]
        below, above = own < pivot, own > pivot
        parts = [(group[above], word), (group[~(below | above)], word + 1), (group[below], word)]
        stack += [p for p in parts if len(p[0])]
    return np.array(out, np.int64)


def neighbour_prefixes(strings: list[bytes], order: np.ndarray, width: int) -> np.ndarray:
    """Longest common prefix, up to ``width``, of each string with the one before it in ``order`` (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    lengths = np.minimum(np.fromiter(map(len, strings), np.int64, len(strings)), width)[order]
    step = 1 << 14
    for a in range(1, len(order), step):
        b = min(len(order), a + step)
        rows = _padded([strings[i] for i in order[a - 1 : b].tolist()], width)
        differs = rows[1:] != rows[:-1]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        out[a:b] = np.minimum(first, np.minimum(lengths[a:b], lengths[a - 1 : b - 1]))
    return out
