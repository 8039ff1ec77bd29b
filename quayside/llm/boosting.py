"""Gradient-boosted trees for a few dozen features and some ten thousand rows, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Second-order boosting of the logistic loss over binned features; every tree is complete to ``depth``."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.ridge = rounds, depth, rate, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        inner = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, j], inner, method="lower")) for j in range(width)]
        binned = self._binned(x)
        self.bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        margin = np.full(n, self.bias)
        self.features = np.zeros((self.rounds, 2**self.depth - 1), np.int64)
        self.edges = np.full((self.rounds, 2**self.depth - 1), BINS, np.int64)
        self.values = np.zeros((self.rounds, 2**self.depth))
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-6)
                for j in range(width):
                    slot = node * BINS + binned[:, j]
                    g = np.cumsum(np.bincount(slot, grad, count * BINS).reshape(count, BINS), 1)
                    h = np.cumsum(np.bincount(slot, hess, count * BINS).reshape(count, BINS), 1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + self.ridge) + (gt - g)**2 / (ht - h + self.ridge) - gt**2 / (ht + self.ridge)
                    at = gain.argmax(1)
                    better = gain[np.arange(count), at] > best
                    best = np.where(better, gain[np.arange(count), at], best)
                    self.features[t, first:first + count][better] = j
                    self.edges[t, first:first + count][better] = at[better]
                node = self._descend(binned, node, t, first)
            g, h = np.bincount(node, grad, 2**self.depth), np.bincount(node, hess, 2**self.depth)
            self.values[t] = -self.rate * g / (h + self.ridge)
            margin += self.values[t][node]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)

    def _descend(self, binned: np.ndarray, node: np.ndarray, t: int, first: int) -> np.ndarray:
        feature, edge = self.features[t, first + node], self.edges[t, first + node]
        return 2 * node + (binned[np.arange(len(node)), feature] > edge)

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        total = np.full(len(x), self.bias)
        for t in range(self.rounds):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = self._descend(binned, node, t, 2**level - 1)
            total += self.values[t][node]
        return total
