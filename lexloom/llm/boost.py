"""Small gradient-boosted trees for binary decisions, fitted on the driver over bounded samples."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic boosting of depth-limited regression trees over quantile thresholds."""

    def __init__(self, rounds: int = 30, depth: int = 3, rate: float = 0.3, cuts: int = 24, leaf: int = 3):
        self.rounds, self.depth, self.rate, self.cuts, self.leaf = rounds, depth, rate, cuts, leaf
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """x: rows x features; y: 0 or 1. With one class only, every score is that class."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        p = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        if len(y) == 0 or y.min() == y.max():
            return self
        edges = [self._thresholds(x[:, j]) for j in range(x.shape[1])]
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-f))
            tree = self._grow(x, y - prob, prob * (1 - prob), edges, np.arange(len(y)), self.depth)
            self.trees.append(tree)
            f += self._apply(tree, x)
        return self

    def _thresholds(self, col: np.ndarray) -> np.ndarray:
        v = np.unique(col)
        mid = (v[1:] + v[:-1]) / 2
        return mid if len(mid) <= self.cuts else np.quantile(mid, np.linspace(0, 1, self.cuts))

    def _grow(self, x, g, h, edges, rows, depth):
        value = self.rate * float(np.clip(g[rows].sum() / (h[rows].sum() + 1.0), -4, 4))
        if depth == 0 or len(rows) < 2 * self.leaf:
            return value
        best, total = None, g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for j, cut in enumerate(edges):
            col = x[rows, j]
            for t in cut:
                left = col <= t
                n = int(left.sum())
                if n < self.leaf or len(rows) - n < self.leaf:
                    continue
                gl, hl = g[rows][left].sum(), h[rows][left].sum()
                gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                gain = gl**2 / (hl + 1.0) + gr**2 / (hr + 1.0) - total
                if gain > 1e-6 and (best is None or gain > best[0]):
                    best = (gain, j, t)
        if best is None:
            return value
        _, j, t = best
        left = x[rows, j] <= t
        return (j, float(t), self._grow(x, g, h, edges, rows[left], depth - 1), self._grow(x, g, h, edges, rows[~left], depth - 1))

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, t, a, b = tree
        out, left = np.empty(len(x)), x[:, j] <= t
        out[left], out[~left] = self._apply(a, x[left]), self._apply(b, x[~left])
        return out

    def probability(self, x) -> np.ndarray:
        x = np.asarray(x, float)
        if not len(x):
            return np.zeros(0)
        f = np.full(len(x), self.base)
        for tree in self.trees:
            f += self._apply(tree, x)
        return 1 / (1 + np.exp(-f))
