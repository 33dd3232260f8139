"""Small gradient-boosted trees for binary labels: histogram splits, logistic loss, numpy only."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Depth-limited trees as flat arrays; `scores` gives log-odds."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 32, reg: float = 1.0, least: int = 8) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.reg, self.least = rounds, depth, rate, bins, reg, least
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        f = np.full(n, self.base)
        nodes = 2 ** (self.depth + 1) - 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
            at = np.zeros(n, dtype=int)
            for node in range(nodes):
                own = np.flatnonzero(at == node)
                if not len(own):
                    continue
                value[node] = self.rate * g[own].sum() / (h[own].sum() + self.reg)
                if node >= nodes // 2 or len(own) < 2 * self.least:
                    continue
                best, split = 1e-6, None
                total_g, total_h = g[own].sum(), h[own].sum()
                for j in range(width):
                    k = len(edges[j]) + 1
                    b = binned[own, j]
                    sg, sh, sn = (np.cumsum(np.bincount(b, w, k))[:-1] for w in (g[own], h[own], None))
                    gain = sg**2 / (sh + self.reg) + (total_g - sg) ** 2 / (total_h - sh + self.reg) - total_g**2 / (total_h + self.reg)
                    gain[(sn < self.least) | (len(own) - sn < self.least)] = 0
                    if len(gain) and gain.max() > best:
                        best, split = gain.max(), (j, int(gain.argmax()))
                if split is not None:
                    feature[node], cut[node] = split[0], edges[split[0]][split[1]]
                    right = binned[own, split[0]] > split[1]
                    at[own] = 2 * node + 1 + right
            f += value[at]
            self.trees.append((feature, cut, value))
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                j = feature[at]
                at = np.where(j < 0, at, 2 * at + 1 + (x[rows, np.maximum(j, 0)] > cut[at]))
            f += value[at]
        return f
