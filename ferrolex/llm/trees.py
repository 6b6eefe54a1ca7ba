"""Bagged decision trees on small feature matrices, trained on the driver from a bounded sample and applied in batches."""

from __future__ import annotations

import numpy as np


class Tree:
    """A binary classification tree grown by Gini impurity; nodes are kept in flat arrays."""

    def __init__(self) -> None:
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []

    def _node(self, value: float) -> int:
        for a, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            a.append(x)
        return len(self.value) - 1

    def grow(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, least: int, tried: int, rng: np.random.Generator) -> int:
        node = self._node(float((y * w).sum() / w.sum()))
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return node
        best = (0.0, -1, 0.0)
        total, positive = w.sum(), (w * y).sum()
        whole = positive * (total - positive) / total
        for f in rng.choice(x.shape[1], size=min(tried, x.shape[1]), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, cw, cp = x[order, f], np.cumsum(w[order]), np.cumsum((w * y)[order])
            at = np.arange(least - 1, len(v) - least)
            at = at[v[at] < v[at + 1]]
            if not len(at):
                continue
            wl, pl = cw[at], cp[at]
            wr, pr = total - wl, positive - pl
            gain = whole - pl * (wl - pl) / wl - pr * (wr - pr) / wr
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), int(f), float((v[at[k]] + v[at[k] + 1]) / 2))
        if best[1] < 0:
            return node
        low = x[:, best[1]] <= best[2]
        self.feature[node], self.threshold[node] = best[1], best[2]
        self.left[node] = self.grow(x[low], y[low], w[low], depth - 1, least, tried, rng)
        self.right[node] = self.grow(x[~low], y[~low], w[~low], depth - 1, least, tried, rng)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, value = np.array(self.left), np.array(self.right), np.array(self.value)
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return value[at]
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])


class BaggedTrees:
    """The mean of trees grown on bootstrap samples, both classes weighted alike."""

    def __init__(self, n_trees: int = 25, depth: int = 8, least: int = 4, seed: int = 7):
        self.n_trees, self.depth, self.least, self.seed = n_trees, depth, least, seed
        self.trees: list[Tree] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BaggedTrees":
        rng = np.random.default_rng(self.seed)
        self.trees = []
        if not len(y):
            return self
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        weights = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
        tried = max(2, int(np.ceil(x.shape[1] / 2)))
        for _ in range(self.n_trees):
            pick = rng.integers(0, len(y), len(y))
            tree = Tree()
            tree.grow(x[pick], y[pick].astype(float), weights[pick], self.depth, self.least, tried, rng)
            self.trees.append(tree)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean probability; 0 without trees."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        return np.mean([t.predict(x) for t in self.trees], axis=0)
