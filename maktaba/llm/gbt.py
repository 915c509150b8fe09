"""Gradient-boosted trees in numpy: histogram splits, monotonic constraints, complete trees as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth. Node i of a tree has the children 2i+1 and 2i+2; the last level holds the values."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): to the right if above
    value: np.ndarray  # (trees, leaves)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row: all rows go down one tree at a time, one level at a time."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)] if len(x) else 0
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 15, l2: float = 1.0) -> Trees:
    """Trees for the log-odds of y (0 or 1). monotone has -1, 0 or 1 for each feature: the score falls, is free, or rises.

    Features must be finite. Of equal gains the first feature, then its least threshold, makes the split. Without rows of
    both labels, or with fewer than 2 * least rows, there are no trees, and all rows get the share of label 1 (0.5 if
    there are no rows).
    """
    inner, leaves = 2**depth - 1, 2**depth
    mean = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
    base = float(np.log(mean / (1 - mean)))
    if len(y) < 2 * least or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    flat = binned + np.arange(width) * bins
    found: list[tuple] = []
    margin = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p) + 1e-9
        feature, threshold, cut = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, bins, np.int64)
        bounds = np.full((inner + leaves, 2), (-np.inf, np.inf))
        node = np.zeros(n, np.int64)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            lo, hi = bounds[at]
            bounds[2 * at + 1] = bounds[2 * at + 2] = lo, hi
            if len(rows) >= 2 * least:
                cells = flat[rows].ravel()
                g = np.bincount(cells, np.repeat(grad[rows], width), width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(cells, np.repeat(hess[rows], width), width * bins).reshape(width, bins).cumsum(1)
                c = np.bincount(cells, minlength=width * bins).reshape(width, bins).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                left, right = np.clip(g / (h + l2), lo, hi), np.clip((gt - g) / (ht - h + l2), lo, hi)
                worth = lambda v, g, h: 2 * v * g - v * v * (h + l2)
                gain = worth(left, g, h) + worth(right, gt - g, ht - h) - worth(np.clip(gt / (ht + l2), lo, hi), gt, ht)
                gain[(c < least) | (len(rows) - c < least) | (monotone[:, None] * (right - left) < 0)] = -np.inf
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, b] > 1e-6:
                    feature[at], threshold[at], cut[at] = j, edges[j][b], b
                    if monotone[j]:
                        middle = (left[j, b] + right[j, b]) / 2
                        bounds[2 * at + 1, 1 if monotone[j] > 0 else 0] = middle
                        bounds[2 * at + 2, 0 if monotone[j] > 0 else 1] = middle
            node[rows] = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value = rate * np.clip(g / (h + l2), bounds[inner:, 0], bounds[inner:, 1])
        margin += value[leaf]
        found.append((feature, threshold, value))
    return Trees(np.array([f for f, _, _ in found]), np.array([t for _, t, _ in found]), np.array([v for _, _, v in found]), base)
