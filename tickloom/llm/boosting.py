"""Gradient boosted trees for two classes, small enough to be fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


class Trees:
    """Logistic boosting of depth-limited trees over quantile bins; prediction is a few array look-ups a tree."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.edges: list[np.ndarray] = []
        self.feature = self.split = self.leaf = None
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins)[1:-1])) for k in range(x.shape[1])]
        b = self._binned(x)
        inner, leaves = 2 ** self.depth - 1, 2 ** self.depth
        self.feature = np.zeros((self.rounds, inner), np.int64)
        self.split = np.full((self.rounds, inner), self.bins)  # all go left where no split pays
        self.leaf = np.zeros((self.rounds, leaves))
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, count = 2 ** level - 1, 2 ** level
                best = np.full(count, 1e-9)
                for k in range(x.shape[1]):
                    cell = (node - first) * (self.bins + 1) + b[:, k]
                    g = np.bincount(cell, gradient, count * (self.bins + 1)).reshape(count, -1).cumsum(1)
                    h = np.bincount(cell, hessian, count * (self.bins + 1)).reshape(count, -1).cumsum(1)
                    r = self.ridge
                    gain = g ** 2 / (h + r) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + r) - g[:, -1:] ** 2 / (h[:, -1:] + r)
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    better = top > best
                    best[better] = top[better]
                    self.feature[t, first:first + count][better] = k
                    self.split[t, first:first + count][better] = at[better]
                node = 2 * node + 1 + (b[np.arange(len(y)), self.feature[t, node]] > self.split[t, node])
            g = np.bincount(node - inner, gradient, leaves)
            h = np.bincount(node - inner, hessian, leaves)
            self.leaf[t] = self.rate * g / (h + self.ridge)
            score += self.leaf[t, node - inner]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1, not calibrated."""
        b = self._binned(x)
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(self.rounds):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, self.feature[t, node]] > self.split[t, node])
            score += self.leaf[t, node - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-score))


def calibrated(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic calibration by pooling neighbours: scores in rising order and the share of positives at each."""
    order = np.argsort(score, kind="stable")
    sums: list[list[float]] = []
    for s, y in zip(score[order].tolist(), label[order].tolist()):
        sums.append([y, 1, s])
        while len(sums) > 1 and sums[-2][0] * sums[-1][1] >= sums[-1][0] * sums[-2][1]:
            y, n, _ = sums.pop()
            sums[-1][0] += y
            sums[-1][1] += n
    return np.array([s for _, _, s in sums]), np.array([y / n for y, n, _ in sums])
