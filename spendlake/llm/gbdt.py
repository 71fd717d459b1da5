"""Gradient-boosted trees for few classes, on small training sets: binned features, softmax loss, shallow trees."""

from __future__ import annotations

import numpy as np


class Booster:
    """One tree per class and round; a node splits a feature at a bin's edge, gains and leaves by second-order terms."""

    def __init__(self, rounds: int = 16, depth: int = 4, rate: float = 0.4, bins: int = 24, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[list[tuple]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, classes: int) -> Booster:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
        scores = np.zeros((len(x), classes))
        for _ in range(self.rounds):
            p = self._softmax(scores)
            grown = []
            for k in range(classes):
                tree: list = []
                self._grow(tree, binned, cuts, p[:, k] - (y == k), p[:, k] * (1 - p[:, k]) + 1e-6, np.arange(len(x)), 0)
                grown.append(tuple(np.array(c) for c in zip(*tree)))
            for k, tree in enumerate(grown):
                scores[:, k] += self._walk(tree, x)
            self.trees.append(grown)
        return self

    def _grow(self, tree, binned, cuts, g, h, rows, depth) -> int:
        at = len(tree)
        total, weight = g[rows].sum(), h[rows].sum()
        tree.append((-1, 0.0, -1, -1, -self.rate * total / (weight + self.ridge)))
        best = (1e-6, None, None)
        if depth < self.depth and len(rows) > 20:
            own = total * total / (weight + self.ridge)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, f], g[rows], len(cut) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, f], h[rows], len(cut) + 1))[:-1]
                gain = gs**2 / (hs + self.ridge) + (total - gs) ** 2 / (weight - hs + self.ridge) - own
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], f, i)
        if best[1] is not None:
            _, f, i = best
            left = binned[rows, f] <= i
            low = self._grow(tree, binned, cuts, g, h, rows[left], depth + 1)
            high = self._grow(tree, binned, cuts, g, h, rows[~left], depth + 1)
            tree[at] = (f, float(cuts[f][i]), low, high, 0.0)
        return at

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        feature, cut, low, high, leaf = tree
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = feature[at]
            down = np.where(x[rows, f] <= cut[at], low[at], high[at])
            at = np.where(f < 0, at, down)
        return leaf[at]

    @staticmethod
    def _softmax(scores: np.ndarray) -> np.ndarray:
        e = np.exp(scores - scores.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        scores = sum(np.stack([self._walk(t, x) for t in trees], 1) for trees in self.trees)
        return np.log(np.maximum(self._softmax(scores), 1e-9))
