"""Gradient-boosted regression trees for the logistic loss, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Sum of depth-`depth` trees; each is (features, cuts) of its inner nodes level by level and its leaf values."""

    depth: int = 3
    rounds: int = 40
    rate: float = 0.3
    bins: int = 32
    ridge: float = 1.0
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees = float(np.log(share / (1 - share))), []
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grown(binned, edges, p - y, p * (1 - p))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _grown(self, binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, curve: np.ndarray):
        node = np.zeros(len(grad), dtype=np.int64)
        inner = 2**self.depth - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(self.depth):
            width, first = 2**level, 2**level - 1
            best = np.full(width, 1e-9)
            where = np.full(width, self.bins)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                slot = node * (self.bins + 1) + binned[:, f]
                sums = [np.bincount(slot, v, minlength=width * (self.bins + 1)).reshape(width, -1).cumsum(1) for v in (grad, curve)]
                (g, h), all_g, all_h = sums, sums[0][:, -1:], sums[1][:, -1:]
                gain = g**2 / (h + self.ridge) + (all_g - g) ** 2 / (all_h - h + self.ridge) - all_g**2 / (all_h + self.ridge)
                at = gain[:, : len(edge)].argmax(1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], where[better] = top[better], at[better]
                feature[first : first + width][better] = f
                cut[first : first + width][better] = edge[at[better]]
            node = 2 * node + (binned[np.arange(len(node)), feature[first + node]] > where[node])
        leaves = 2**self.depth
        g, h = (np.bincount(node, v, minlength=leaves) for v in (grad, curve))
        return (feature, cut, -self.rate * g / (h + self.ridge)), node

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            score += leaf[node]
        return 1 / (1 + np.exp(-score))
