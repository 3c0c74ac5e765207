"""Histogram gradient-boosted trees: binned features, logistic loss, complete trees stored as
flat arrays so that a whole batch walks a level of a tree with one indexing step."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """``feature`` and ``cut`` are (trees, 2^depth - 1) in heap order, ``leaf`` is (trees, 2^depth).
    A row goes right at a node when its value is greater than the cut."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        n = len(x)
        margin = np.full(n, self.prior)
        rows = np.arange(n)
        inner = self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(n, np.int64)
            while n and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            margin += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, bins: int = 64,
        rate: float = 0.15, l2: float = 1.0, min_rows: int = 10) -> FlatTrees:
    """Fit on ``x`` (rows, features) and labels 0/1.  With fewer than two classes, no trees:
    every row then gets the smoothed share of class 1 (1 without any rows)."""
    inner = (1 << depth) - 1
    share = (y.sum() + 1.0) / (len(y) + (2.0 if len(y) else 1.0 + 1e-6))
    prior = float(np.log(share / max(1e-9, 1.0 - share)))
    if len(y) == 0 or y.min() == y.max():
        return FlatTrees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), prior)
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], axis=1)
    offset = np.arange(m) * bins
    margin = np.full(n, prior)
    feature, cut, leaf = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = p - y, p * (1.0 - p)
        node = np.zeros(n, np.int64)
        tf, tc = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * (m * bins) + offset + binned).ravel()
            size = width * m * bins
            g = np.bincount(slot, np.repeat(grad, m), size).reshape(width, m, bins).cumsum(2)
            h = np.bincount(slot, np.repeat(hess, m), size).reshape(width, m, bins).cumsum(2)
            c = np.bincount(slot, minlength=size).reshape(width, m, bins).cumsum(2)
            gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g * g / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt * gt / (ht + l2)
            gain[(c < min_rows) | (ct - c < min_rows)] = -np.inf
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if flat[k, best[k]] > 1e-6 and b < len(cuts[j]):
                    tf[first + k], tc[first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), tf[node]] > tc[node])
        at = node - inner
        value = -rate * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + l2)
        margin += value[at]
        feature.append(tf)
        cut.append(tc)
        leaf.append(value)
    return FlatTrees(np.stack(feature), np.stack(cut), np.stack(leaf), prior)
