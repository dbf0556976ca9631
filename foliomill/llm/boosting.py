"""Gradient-boosted trees for two classes: histogram trees over small dense feature tables, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Additive trees of a fixed depth on the logistic loss; a tree is three flat arrays."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.25, l2: float = 1.0, least: int = 8):
        self.rounds, self.depth, self.rate, self.l2, self.least = rounds, depth, rate, l2, least
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(np.unique(c)) > BINS else (np.unique(c)[:-1] + np.unique(c)[1:]) / 2 for c in x.T]
        b = self._binned(x)
        n, f = b.shape
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(n, self.base)
        column = np.arange(f) * (BINS + 1)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)
            feature, split, value = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, BINS + 1), np.zeros(2**self.depth)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                width = 2**level
                flat = (node[:, None] * f * (BINS + 1) + column + b).ravel()
                size = width * f * (BINS + 1)
                hist = [np.bincount(flat, np.repeat(w, f), size).reshape(width, f, BINS + 1).cumsum(2) for w in (g, h, np.ones(n))]
                (gl, hl, cl), (gt, ht, ct) = hist, (a[:, :, -1:] for a in hist)
                gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
                gain[(cl < self.least) | (ct - cl < self.least)] = 0
                best = gain.reshape(width, -1).argmax(1)
                at = slice(width - 1, 2 * width - 1)
                useful = gain.reshape(width, -1).max(1) > 1e-6
                feature[at] = np.where(useful, best // (BINS + 1), 0)
                split[at] = np.where(useful, best % (BINS + 1), BINS + 1)
                k = width - 1 + node
                node = node * 2 + (b[np.arange(n), feature[k]] > split[k])
            total = [np.bincount(node, w, 2**self.depth) for w in (g, h)]
            value = self.rate * total[0] / (total[1] + self.l2)
            score += value[node]
            self.trees.append((feature, split, value))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1 for each row."""
        if not len(x):
            return np.zeros(0)
        b = self._binned(x)
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, split, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                k = 2**level - 1 + node
                node = node * 2 + (b[rows, feature[k]] > split[k])
            out += value[node]
        return out
