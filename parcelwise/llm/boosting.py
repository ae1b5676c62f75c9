"""Gradient-boosted trees for a yes/no label, in numpy, for small bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node k has the children 2k + 1 and 2k + 2; leaves come last."""

    prior: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray
    leaves: np.ndarray  # trees x 2 ** depth

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row."""
        out = np.full(len(x), self.prior)
        rows, inner = np.arange(len(x)), self.features.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Logistic loss, second-order leaf values, splits among ``bins`` quantiles of each feature."""
    inner = 2**depth - 1
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(prior, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T)], axis=1)
    score = np.full(len(y), prior)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            own = node == k
            if not own.any():
                node[own] = 2 * k + 1
                continue
            g, h, best = slope[own], curve[own], (1e-9, 0, np.inf)
            base = g.sum() ** 2 / (h.sum() + ridge)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                left_g = np.cumsum(np.bincount(binned[own, f], g, len(e) + 1))[:-1]
                left_h = np.cumsum(np.bincount(binned[own, f], h, len(e) + 1))[:-1]
                gain = left_g**2 / (left_h + ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge) - base
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, float(e[at]))
            feature[k], threshold[k] = best[1], best[2]
            node[own] = 2 * k + 1 + (x[own, best[1]] > best[2])
        g = np.bincount(node - inner, slope, inner + 1)
        h = np.bincount(node - inner, curve, inner + 1)
        leaves = rate * g / (h + ridge)
        score += leaves[node - inner]
        made.append((feature, threshold, leaves))
    return Trees(prior, *(np.stack(part) for part in zip(*made)))
