"""Gradient-boosted regression trees with logistic loss, in numpy.

For models that are fitted on a bounded sample and sent to all tasks. Features
are cut at quantiles into at most ``BINS`` bins; a tree is grown level by level
from histograms of gradients.
"""

from __future__ import annotations

import numpy as np

BINS = 32
PENALTY = 1.0


class BoostedTrees:
    def __init__(self, trees: int = 60, depth: int = 5, rate: float = 0.25, least: float = 3.0):
        self.trees, self.depth, self.rate, self.least = trees, depth, rate, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "BoostedTrees":
        weight = np.ones(len(x)) if weight is None else weight
        n_features = x.shape[1]
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
        binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(n_features)], axis=1)
        mean = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(mean / (1 - mean)))
        margin = np.full(len(x), self.start)
        nodes = 2 ** (self.depth + 1) - 1
        shape = (self.trees, nodes)
        self.feature, self.cut, self.value = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
        column = np.arange(n_features) * BINS
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (p - y), weight * p * (1 - p) + 1e-12
            at = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth + 1):
                first = 2**level - 1
                for node in range(first, 2 * first + 1):
                    rows = np.flatnonzero(at == node)
                    if not len(rows):
                        continue
                    gs, hs = g[rows].sum(), h[rows].sum()
                    self.value[t, node] = -self.rate * gs / (hs + PENALTY)
                    if level == self.depth:
                        continue
                    cell = (binned[rows] + column).ravel()
                    hist = [
                        np.cumsum(np.bincount(cell, np.repeat(v[rows], n_features), n_features * BINS).reshape(n_features, BINS), axis=1)
                        for v in (g, h)
                    ]
                    gl, hl = hist
                    gain = gl**2 / (hl + PENALTY) + (gs - gl) ** 2 / (hs - hl + PENALTY) - gs**2 / (hs + PENALTY)
                    gain[(hl < self.least * 0.25) | (hs - hl < self.least * 0.25)] = 0
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] <= 1e-6 or b >= len(cuts[f]):
                        continue
                    self.feature[t, node], self.cut[t, node] = f, cuts[f][b]
                    at[rows] = 2 * node + 1 + (binned[rows, f] > b)
            margin += self.value[t, at]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(self.trees):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t, at]
                step = 2 * at + 1 + (x[rows, f] > self.cut[t, at])
                at = np.where(f >= 0, step, at)
            out += self.value[t, at]
        return out
