"""Deep-shallow sorting of byte strings (suffixes or their inverses).

Shallow: multikey quicksort, eight bytes a character, on all groups of strings
at once: every open segment is split in three around its middle string's
character, and the equal part goes on with the next character.  Deep: segments
that agree over SHALLOW characters have long common prefixes; a blind trie
orders each (strings are led down by single bytes, and compared with one leaf).
"""

from __future__ import annotations

import numpy as np

#: Depth of the quicksort in characters of eight bytes.
SHALLOW = 4


def words(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings as rows of big-endian 64-bit words, zero-padded, and lengths."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    width = max(8, -(-int(sizes.max(initial=0)) // 8) * 8)
    flat = b"".join([s.ljust(width, b"\0") for s in strings])
    return np.frombuffer(flat, ">u8").reshape(len(strings), -1).astype(np.uint64), sizes


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Branch:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int):
        self.depth = depth
        self.kids: dict[int, object] = {}


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_trie(strings: list[bytes], members: list[int]) -> list[int]:
    """``members`` in the order of their strings."""
    root: object = [members[0]]
    for m in members[1:]:
        s, node = strings[m], root
        while isinstance(node, _Branch):
            kid = node.kids.get(_byte(s, node.depth))
            node = kid if kid is not None else next(iter(node.kids.values()))
        like = strings[node[0]]
        n = common(s, like)
        if n == len(s) == len(like):
            node.append(m)
            continue
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < n:
            above, node = node, node.kids[_byte(s, node.depth)]
        if isinstance(node, _Branch) and node.depth == n:
            node.kids[_byte(s, n)] = [m]
            continue
        split = _Branch(n)
        split.kids[_byte(like, n)] = node
        split.kids[_byte(s, n)] = [m]
        if above is None:
            root = split
        else:
            above.kids[_byte(s, above.depth)] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack.extend(node.kids[c] for c in sorted(node.kids, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the strings of each group.  ``groups`` is non-decreasing.  Returns the
    order, and each place's common prefix with the place before (-1 where a
    group begins)."""
    n = len(strings)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    w, sizes = words(strings)
    order = np.arange(n)
    place = np.arange(n)                       # places still open
    segment = groups.copy()
    depth = np.zeros(n, np.int64)              # by open place
    deep: list[np.ndarray] = []
    while True:
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(place) else place
        counts = np.diff(np.append(starts, len(place)))
        is_deep = depth[starts] >= min(SHALLOW, w.shape[1]) if len(place) else starts
        for s in np.flatnonzero(is_deep & (counts > 1)) if len(place) else ():
            deep.append(place[starts[s]:starts[s] + counts[s]])
        go = np.repeat(~is_deep & (counts > 1), counts) if len(place) else np.empty(0, bool)
        place, segment, depth = place[go], segment[go], depth[go]
        if not len(place):
            break
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        counts = np.diff(np.append(starts, len(place)))
        char = w[order[place], depth]
        pivot = np.repeat(char[starts + counts // 2], counts)
        side = (char > pivot).astype(np.int64) - (char < pivot) + 1
        part = np.repeat(np.arange(len(starts)), counts) * 3 + side
        by = np.argsort(part, kind="stable")
        order[place] = order[place][by]
        depth = depth[by] + (side[by] == 1)
        segment = part[by]
    for p in deep:
        order[p] = blind_trie(strings, order[p].tolist())
    return order, neighbours(w, sizes, order, groups)


def neighbours(w: np.ndarray, sizes: np.ndarray, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
    a, b = w[order[:-1]], w[order[1:]]
    differ = a != b
    at = differ.argmax(axis=1)
    row = np.arange(len(at))
    x = a[row, at] ^ b[row, at]
    zeros = np.zeros(len(at), np.int64)
    for k in range(1, 8):
        zeros += x < (np.uint64(1) << np.uint64(64 - 8 * k))
    lcp = np.where(differ.any(axis=1), at * 8 + zeros, 8 * w.shape[1])
    lcp = np.minimum(lcp, np.minimum(sizes[order[:-1]], sizes[order[1:]]))
    lcp[groups[1:] != groups[:-1]] = -1
    return np.concatenate([[-1], lcp])
