"""Gradient-boosted trees for a logistic loss, on small tables, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """score(x) is a log-odds; trees have ``depth`` levels of one split each per node."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.25, least: int = 8, shrink: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.least, self.shrink = trees, depth, rate, least, shrink

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        self.cuts = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, 33))) for c in x.T]
        #: per tree: feature and cut of each inner node in heap order, then a value per leaf
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        f = np.full(len(y), self.base)
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-f))
            tree = self._grow(x, y - q, q * (1 - q))
            self.model.append(tree)
            f += self._apply(tree, x)
        return self

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        inner = 2**self.depth - 1
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(x), int)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            best = (1e-9, 0, np.inf)
            if len(here) >= 2 * self.least:
                gs, hs = g[here].sum(), h[here].sum()
                for j, cuts in enumerate(self.cuts):
                    # sums on the left of each cut, from one histogram
                    b = np.searchsorted(cuts, x[here, j], "left")
                    n = np.cumsum(np.bincount(b, minlength=len(cuts) + 1))[:-1]
                    gl = np.cumsum(np.bincount(b, g[here], len(cuts) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[here], len(cuts) + 1))[:-1]
                    gain = gl**2 / (hl + self.shrink) + (gs - gl) ** 2 / (hs - hl + self.shrink) - gs**2 / (hs + self.shrink)
                    gain[(n < self.least) | (len(here) - n < self.least)] = -1
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (float(gain[i]), j, float(cuts[i]))
            feature[k], cut[k] = best[1], best[2]
            node[here] = 2 * k + 1 + (x[here, feature[k]] > cut[k])
        leaf = node - inner
        value = self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.shrink)
        return feature, cut, value

    def _apply(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        return value[node - len(feature)]

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.model:
            out += self._apply(tree, x)
        return out
