"""Deep-shallow suffix sorting up to a fixed depth.

Shallow: multikey quicksort, eight bytes as one symbol. All groups of a level are partitioned at once;
only groups with more than one suffix go on. Deep: suffixes that still agree after ``shallow`` bytes
go, group by group, into a blind trie. It descends by the bytes at its branching depths alone, then
compares one string, and so orders long common prefixes with one comparison per suffix.
"""

from __future__ import annotations

import numpy as np


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for i in range(8):
        out |= padded[i : i + len(data)] << np.uint64(56 - 8 * i)
    return out


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    differing = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differing.bit_length() + 7) // 8


class BlindTrie:
    """Strings of one length in order; equal strings share a leaf.

    An inner node is (depth, {byte: child}); a leaf is a list, its string first, then the numbers
    added with that string.
    """

    def __init__(self) -> None:
        self.root = None

    def add(self, number: int, string: bytes) -> None:
        node = self.root
        if node is None:
            self.root = [string, number]
            return
        while type(node) is tuple:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = node[0]
        if other == string:
            node.append(number)
            return
        depth = common_prefix(string, other)
        above, node = None, self.root
        while type(node) is tuple and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        leaf = [string, number]
        if type(node) is tuple and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        inner = (depth, {other[depth]: node, string[depth]: leaf})
        if above is None:
            self.root = inner
        else:
            above[1][string[above[0]]] = inner

    def leaves(self):
        """The numbers of each leaf, in the order of the strings."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
            else:
                yield node[1:]


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at ``starts``, compared over ``depth`` bytes, and for each
    place in that order whether its suffix differs from the one before.

    Every suffix must have ``depth`` bytes; equal ones keep the order they came in.
    """
    order, fresh = np.arange(len(starts)), np.zeros(len(starts), dtype=bool)
    if not len(starts):
        return order, fresh
    fresh[0] = True
    shallow = min(shallow, depth) // 8 * 8
    symbols = eights(data) if shallow else None
    for at in range(0, shallow, 8):
        group = np.cumsum(fresh)
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(several):
            return order, fresh
        key = symbols[starts[order[several]] + at]
        by = np.lexsort((key, group[several]))
        order[several] = order[several][by]
        key, group = key[by], group[several]
        fresh[several[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    if shallow == depth:
        return order, fresh
    whole = data.tobytes()
    heads = np.flatnonzero(fresh)
    ends = np.append(heads[1:], len(order))
    for head, end in zip(heads[ends - heads > 1].tolist(), ends[ends - heads > 1].tolist(), strict=True):
        trie = BlindTrie()
        for number in order[head:end].tolist():
            start = int(starts[number])
            trie.add(number, whole[start + shallow : start + depth])
        at = head
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            fresh[at] = True
            at += len(leaf)
    return order, fresh
