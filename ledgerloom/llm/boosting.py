"""Gradient-boosted regression trees for two classes, in numpy: histogram splits, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray     # trees x inner nodes of a complete tree
    cut: np.ndarray
    value: np.ndarray       # trees x leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        total = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[0:1].size and node[0] < inner:     # all rows are at one depth
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 48,
        least: int = 10, ridge: float = 1.0) -> Trees:
    """Boost ``trees`` complete trees of ``depth`` on rows ``x`` with labels 0 or 1."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    n_bins = max(len(c) for c in cuts) + 1
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    inner = 2 ** depth - 1
    feature, cut, value = (np.zeros((trees, n), t) for n, t in ((inner, np.int64), (inner, float), (inner + 1, float)))
    cut[:] = np.inf
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            best = np.full(many, 1e-9)
            for f in range(x.shape[1]):
                at = (node - first) * n_bins + binned[f]
                size = many * n_bins
                g, h, c = (np.bincount(at, w, size).reshape(many, n_bins).cumsum(axis=1) for w in (grad, hess, None))
                gl, hl, cl = g[:, :-1], h[:, :-1], c[:, :-1]
                gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - (g[:, -1:] ** 2) / (h[:, -1:] + ridge)
                gain[(cl < least) | (cr < least)] = 0
                k = gain.argmax(axis=1)
                found = gain[np.arange(many), k]
                for m in np.flatnonzero(found > best):
                    if k[m] < len(cuts[f]):
                        best[m] = found[m]
                        feature[t, first + m], cut[t, first + m] = f, cuts[f][k[m]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, inner + 1) for w in (grad, hess))
        value[t] = rate * g / (h + ridge)
        total += value[t][leaf]
    return Trees(base, feature, cut, value)
