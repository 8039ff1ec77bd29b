"""Joining two collections of token sets by signature trees.

A set's signature is a bitmap of its hashed tokens. Tree nodes hold the OR of their members' bitmaps, the range of their
sizes and the largest number of tokens beyond the first on a bit. Two sets share at most as many tokens as their
bitmaps share bits, plus the smaller number of such further tokens; the same bound on two nodes holds for all pairs
below them. The dual traversal starts at the roots and drops every node pair whose bound is below what the smallest
sizes in it would need.
"""

from __future__ import annotations

import numpy as np

FAN = 8
_BATCH = 1 << 14


def _needed(a, b, percent: int):
    """The least intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class SignatureTree:
    """Levels from the sets (0) to a few roots; each node of a level covers ``FAN`` neighbours of the level below."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        sizes = np.array([len(s) for s in sets], np.int64)
        bitmap = np.zeros((len(sets), bits // 64), np.uint64)
        for k, tokens in enumerate(sets):
            at = tokens % np.uint64(bits)
            np.bitwise_or.at(bitmap[k], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        extra = sizes - np.bitwise_count(bitmap).sum(1, dtype=np.int64)
        self.levels = [(bitmap, sizes, sizes, extra)]
        while len(self.levels[-1][1]) > FAN:
            below = self.levels[-1]
            first = np.arange(0, len(below[1]), FAN)
            self.levels.append((np.bitwise_or.reduceat(below[0], first), np.minimum.reduceat(below[1], first),
                                np.maximum.reduceat(below[2], first), np.maximum.reduceat(below[3], first)))


def possible_pairs(tree: SignatureTree, percent: int):
    """Batches of index pairs (i < j) of the tree's sets that the bounds cannot exclude."""
    top = len(tree.levels) - 1
    i, j = np.triu_indices(len(tree.levels[top][1]))
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if len(i) > _BATCH:
            stack += [(level, i[_BATCH:], j[_BATCH:]), (level, i[:_BATCH], j[:_BATCH])]
            continue
        bitmap, least, most, extra = tree.levels[level]
        # Sizes first: with the smaller set inside the larger one, their ratio is the similarity.
        fits = (100 * most[i] >= percent * least[j]) & (100 * most[j] >= percent * least[i])
        i, j = i[fits], j[fits]
        shared = np.bitwise_count(bitmap[i] & bitmap[j]).sum(1, dtype=np.int64) + np.minimum(extra[i], extra[j])
        shared = np.minimum(shared, np.minimum(most[i], most[j]))
        stay = (shared >= _needed(least[i], least[j], percent)) | ((i == j) & (level > 0))
        i, j = i[stay], j[stay]
        if level == 0:
            apart = i < j
            yield i[apart], j[apart]
        elif len(i):
            below = len(tree.levels[level - 1][1])
            a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
            b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            inside = (a < below) & (b < below) & (a <= b)
            stack.append((level - 1, a[inside], b[inside]))


def linking_edges(sets: list[np.ndarray], percent: int, component: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs with the similarity, as many as it takes to connect what links connect; ``component`` numbers what is
    known to be connected already. ``sets`` are sorted arrays of distinct 64-bit tokens, by size."""
    component = component.copy()
    bits = 64
    while bits < min(4 * max(map(len, sets)), 1 << 15):
        bits *= 2
    edges = []
    for i, j in possible_pairs(SignatureTree(sets, bits), percent):
        while len(i):
            open_ = component[i] != component[j]
            i, j = i[open_], j[open_]
            done = 0
            for a, b in zip(i.tolist(), j.tolist()):
                done += 1
                if component[a] == component[b]:
                    continue
                x, y = sets[a], sets[b]
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                same = int(np.count_nonzero(y[at] == x))
                if 100 * same >= percent * (len(x) + len(y) - same):
                    edges.append((a, b))
                    component[component == component[b]] = component[a]
                    if len(i) - done > 64:
                        break
            i, j = i[done:], j[done:]
    return edges
